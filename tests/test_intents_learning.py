"""Distances, features, classifiers and whole jobs."""

import math
import os

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.vectors import cosine_distance
from callsift.operators import features as X
from callsift.operators import intents as I
from callsift.operators import learning as L
from callsift.operators import lexicon as LX
from callsift.operators import ordering as O
from callsift.operators import rules
from callsift.operators import word_vectors as WV
from callsift.operators.calls import ID
from callsift.plans import jobs
from callsift.session import stage, staged
from callsift.sources import sinks

KEYS = ["doc", "chunk"]
CHUNKS = f"{ID} string, chunk_id long, text string"


def letters():
    return I.letter_count_matrix


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 7, i % 3, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    rows.append((0, 0, [0.0] * 8))
    return spark.createDataFrame(rows, "doc int, chunk int, vec array<float>")


@pytest.fixture(scope="module")
def pack():
    rng = np.random.default_rng(4)
    return I.IntentPack.of({"a": rng.normal(size=(5, 8)), "b": rng.normal(size=(3, 8))})


def cos(a, b):
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return 1.0 if n == 0 else min(max(1 - float(np.dot(a, b)) / n, 0), 2)


def test_row_distances(vectors, pack):
    for row in I.with_distances(vectors, "vec", {"d": pack}).collect():
        want = [cos(np.float32(row["vec"]).astype(float), r) for r in pack.vectors["a"]]
        assert row["d_a"] == pytest.approx(want)


def test_column_distance(make):
    rows = make([([1.0, 0.0], [0.0, 1.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-3.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in rows.select(cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1.0, 0.0, 1.0, 2.0])


def test_least_is_the_minimum_of_all(vectors, pack):
    scored = I.with_distances(vectors, "vec", {"d": pack})
    every = I.all_distances_by_intent(scored, KEYS, "d", pack)
    least = I.min_distances_by_intent(scored, KEYS, "d", pack)
    for r in every.join(least.withColumnsRenamed({"a": "la", "b": "lb"}), KEYS).collect():
        assert min(r["a"]) == pytest.approx(r["la"]) and min(r["b"]) == pytest.approx(r["lb"])
    assert pack.sizes() == {"a": 5, "b": 3}


def test_chunk_without_sentences_is_at_distance_one(spark, vectors, pack):
    scored = I.with_distances(vectors, "vec", {"d": pack})
    chunks = spark.createDataFrame([(0, 0), (99, 0)], "doc int, chunk int")
    got = {r["doc"]: r["dist"] for r in I.min_distance(scored, KEYS, "d_a", chunks).collect()}
    assert got[99] == 1.0 and got[0] < 1.0
    every = I.all_distances(scored, KEYS, "d_a", 5, chunks).filter("doc = 99").first()
    assert every["dists"] == [1.0] * 5


def table_of(spark, pack, intent="a"):
    return spark.createDataFrame([(j, [float(x) for x in v]) for j, v in enumerate(pack.vectors[intent])], "j int, vec array<double>")


def plain_least(rows, refs):
    """(distance, order) of the nearest reference of each row, by a loop."""
    for v in rows:
        found = sorted((round(cos(np.array(v), np.array(r)), 9), j) for j, r in refs)
        yield found[0]


def test_table_of_references_gives_the_same_minimum(spark, vectors, pack):
    scored = I.least_distances(vectors, "vec", table_of(spark, pack), pivots=2).withColumn("dists", F.array("dist"))
    got = I.min_distance(scored, KEYS, "dists").orderBy(*KEYS).collect()
    want = I.min_distance(I.with_distances(vectors, "vec", {"d": pack}), KEYS, "d_a").orderBy(*KEYS).collect()
    assert [r["dist"] for r in got] == pytest.approx([r["dist"] for r in want])


@pytest.mark.parametrize("block,parts", [(4000, 20_000), (3, 7)])
def test_least_distances_match_a_loop(spark, monkeypatch, block, parts):
    monkeypatch.setattr(I, "CLUSTER_BLOCK", block)
    monkeypatch.setattr(I, "PART_ROWS", parts)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 5))
    refs = [(j, [float(x) for x in centres[j % 6] + rng.normal(size=5) / 8]) for j in range(90)]
    refs += [(90 + j, refs[7][1]) for j in range(9)]  # ties
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=5) / 8]) for i in range(80)] + [(80 + i, refs[7][1]) for i in range(30)]
    odd = [(200, None), (201, []), (202, [1.0]), (203, [float("nan")] * 5), (204, [None] * 5)]
    zero = [(205, [0.0] * 5), (206, [-x for x in refs[0][1]])]
    for more, zeros in (([], 0), ([(300, [0.0] * 5), (301, None), (302, [1.0] * 4), (303, [float("inf")] * 5)], 1)):
        given = spark.createDataFrame(refs + more, "j int, vec array<double>")
        asked = spark.createDataFrame([(i, v, "x") for i, v in rows + odd + zero], "id int, vec array<double>, dist string")
        got = {r["id"]: r for r in I.least_distances(asked, "vec", given).collect()}
        assert len(got) == len(rows) + 7 and all(got[i]["dist"] is None and got[i]["nearest"] is None for i, _ in odd)
        usable = refs + [m for m in more if m[0] == 300]
        for (i, _), (dist, j) in zip(rows + zero, plain_least([v for _, v in rows + zero], usable), strict=True):
            assert got[i]["dist"] == pytest.approx(dist, abs=1e-8) and got[i]["seen"] == len(refs) + zeros
            if i not in range(80, 110):
                assert got[i]["nearest"] == j
        made = sum(got[i]["multiplied"] for i, _ in rows)
        assert made < 0.5 * len(rows) * len(refs)
    empty = I.least_distances(asked, "vec", given.filter("j < 0")).collect()
    assert len(empty) == len(rows) + 7 and all(r["dist"] is None for r in empty)
    assert I.least_distances(asked.limit(0), "vec", given).collect() == []


def test_pruning_on_clusters(spark):
    """The share of products that are made, on clustered data."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 32))
    cloud = lambda n: [(i, [float(x) for x in centres[i % 40] + rng.normal(size=32) / 10]) for i in range(n)]
    refs, rows = cloud(4000), cloud(1000)
    got = I.least_distances(spark.createDataFrame(rows, "id int, vec array<double>"), "vec", spark.createDataFrame(refs, "j int, vec array<double>"))
    found = got.agg(F.sum("multiplied"), F.sum("seen")).first()
    assert found[0] < 0.3 * found[1] and found[1] == 4000 * 1000
    unit = [np.array([v for _, v in x]) for x in (rows, refs)]
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in unit]
    assert [r["dist"] for r in got.orderBy("id").collect()] == pytest.approx(list(1 - (unit[0] @ unit[1].T).max(axis=1)))


def test_copies_of_a_row_are_bounded_by_cells(spark, monkeypatch):
    """Where nothing can be pruned a row is sent once to each cell, and cells are few beside the pivots."""
    rng = np.random.default_rng(8)
    points, sizes = rng.normal(size=(300, 16)), rng.integers(0, 50, 300)
    sizes[7] = 1000
    groups, cells = I._cells(points / np.linalg.norm(points, axis=1, keepdims=True), sizes, 200)
    assert sorted(c for g in groups for c in g) == np.flatnonzero(sizes).tolist()
    assert all(sizes[g].sum() <= 200 * n for g, n in zip(groups, cells, strict=True)) and cells.max() == 5
    assert cells.sum() <= 2 * sizes.sum() / 200 + 2
    monkeypatch.setattr(I, "CLUSTER_BLOCK", 100)
    monkeypatch.setattr(I, "COPIES", 7)
    cloud = lambda n: [(i, [float(x) for x in rng.normal(size=16)]) for i in range(n)]
    refs, rows = cloud(600), cloud(90)
    got = I.least_distances(spark.createDataFrame(rows, "id int, vec array<double>"), "vec", spark.createDataFrame(refs, "j int, vec array<double>"))
    want = plain_least([v for _, v in rows], refs)
    for r, (dist, j) in zip(got.orderBy("id").collect(), want, strict=True):
        assert r["dist"] == pytest.approx(dist, abs=1e-8) and r["nearest"] == j and r["seen"] == 600


def test_cells_met_in_rounds_give_the_same_minimum(spark, monkeypatch):
    """Copies on their way are bounded: more go in rounds, whose answers alone are kept, and references are kept once."""
    monkeypatch.setattr(I, "CLUSTER_BLOCK", 50)
    monkeypatch.setattr(I, "ROUND_VALUES", 5000)
    rng = np.random.default_rng(9)
    cloud = lambda n: [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    refs, rows = cloud(300), cloud(70)
    written = []
    monkeypatch.setattr(I, "stage", lambda df: written.append(stage(df)) or written[-1])
    got = I.least_distances(spark.createDataFrame(rows, "id int, vec array<double>"), "vec", spark.createDataFrame(refs, "j int, vec array<double>"))
    want = plain_least([v for _, v in rows], refs)
    for r, (dist, j) in zip(got.orderBy("id").collect(), want, strict=True):
        assert r["dist"] == pytest.approx(dist, abs=1e-8) and r["nearest"] == j and r["seen"] == 300
    assert sum("dist" in w.columns for w in written) >= 2
    left = [w.columns for w in written if os.path.exists(w.inputFiles()[0].removeprefix("file://"))]
    assert sum("_unit" in columns for columns in left) == 1


def test_every_embedding_meets_every_reference(spark, tmp_path):
    import __spark_entry__ as entry

    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, size=64)], 0) for i in range(230)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    scale = lambda v: np.repeat([(b + v) % 7 - 3 for b in range(6)], 64)
    plain = np.array([r[1] for r in rows])
    wide = [np.tile(plain, 6) * scale(v) for v in range(4)]
    unit = [w / np.linalg.norm(w, axis=1, keepdims=True) for w in wide]
    want = 1 - np.maximum.reduce([unit[3] @ unit[v].T for v in range(3)]).max(axis=1)
    got = entry.queries()["i2_all_many_references"](spark, str(tmp_path)).orderBy("vec_id").collect()
    assert [r["vec_id"] for r in got] == list(range(230)) and {r["n"] for r in got} == {690}
    assert [r["least"] for r in got] == pytest.approx(want, abs=2e-6)


SAID = [(0, "I am moving to another town. Please cancel my plan! Thank you."), (1, "yes."), (2, ""), (3, None), (4, "moving. moving house, moving."), (5, "z " * 300)]
REFERENCES = {"a": ["i am moving house", "cancel my plan", "thank you"] * 5, "b": ["moving to another town", "no"]}


@pytest.mark.parametrize("how", ["all", "min"])
@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("block", [4_000_000, 60])
@pytest.mark.parametrize("encoder", [{"column_encoder": I.letter_counts}, {"batch_encoder": lambda: I.letter_count_matrix}])
def test_packs_of_any_size_give_the_same_distances(spark, monkeypatch, how, stored, block, encoder):
    chunks = spark.createDataFrame([(i, t, "x") for i, t in SAID], "id int, text string, _n string").drop("_n")
    small = I.IntentPack.encode(REFERENCES, I.letter_count_matrix)
    rows = [(k, j, [float(x) for x in v]) for k, m in small.vectors.items() for j, v in enumerate(m)]
    want = I.intent_distances(chunks, "text", small, how, **encoder).orderBy("id").collect()
    pairs = {"p": ["i am moving/i am not moving", "cancel/keep it"] * 4}
    opposed = I.OpposedPack.encode(pairs, I.letter_count_matrix)
    want_opposed = I.opposed_distances(chunks, "text", opposed, how, **encoder).orderBy("id").collect()
    monkeypatch.setattr(I, "MAX_PLAN_VALUES", 10)
    monkeypatch.setattr(I, "BLOCK_VALUES", block)
    table = spark.createDataFrame(rows, "intent string, j int, vec array<double>")
    pack = I.IntentPack.from_rows(table, "intent", "j", "vec") if stored else small
    assert isinstance(pack, I.StoredPack) == stored and pack.sizes() == {"a": 15, "b": 2}
    got = I.intent_distances(chunks, "text", pack, how, **encoder).orderBy("id").collect()
    assert [r["id"] for r in got] == [r["id"] for r in want]
    for g, w in zip(got, want, strict=True):
        for c in ("a", "b"):
            assert g[c] == pytest.approx(w[c], abs=1e-12)
    got = I.opposed_distances(chunks, "text", opposed, how, **encoder).orderBy("id").collect()
    for g, w in zip(got, want_opposed, strict=True):
        assert g["p"] == pytest.approx(w["p"], abs=1e-12)


@pytest.mark.parametrize("how", ["all", "min"])
def test_large_packs_write_no_distances(spark, monkeypatch, tmp_path, how):
    """Neither arrays of all distances nor chunks with their vectors are staged, however many blocks there are."""
    chunks = spark.createDataFrame([(i, t) for i, t in SAID], "id int, text string")
    rows = [(k, j, [float(x) for x in v]) for k, m in REFERENCES.items() for j, v in enumerate(I.letter_count_matrix(m))]
    want = I.intent_distances(chunks, "text", I.IntentPack.encode(REFERENCES, I.letter_count_matrix), how, column_encoder=I.letter_counts).orderBy("id").collect()
    for name, value in (("MAX_PLAN_VALUES", 10), ("BLOCK_VALUES", 60), ("OUT_VALUES", 40)):
        monkeypatch.setattr(I, name, value)
    pack = I.IntentPack.from_rows(spark.createDataFrame(rows, "intent string, j int, vec array<double>"), "intent", "j", "vec")
    written = []
    monkeypatch.setattr(I, "stage", lambda df: written.append(df.columns) or stage(df))
    got = I.intent_distances(chunks, "text", pack, how, batch_encoder=lambda: I.letter_count_matrix).orderBy("id").collect()
    assert not any({"_flat", "d_a", "d_b"} <= set(columns) for columns in written)
    for g, w in zip(got, want, strict=True):
        assert g["a"] == pytest.approx(w["a"], abs=1e-12) and g["b"] == pytest.approx(w["b"], abs=1e-12)


def test_chunks_of_one_partition_go_past_large_packs_in_several_tasks(spark, monkeypatch):
    """Few bytes of chunks are work for all cores, equal chunks have equal distances, and single precision stays so in blocks."""
    monkeypatch.setattr(I, "MAX_PLAN_VALUES", 10)
    monkeypatch.setattr(I, "BLOCK_VALUES", 60)
    monkeypatch.setattr(I, "PASS_VALUES", 40)
    said = [(i, f"i am moving to town {'abc' * (i % 5)}") for i in range(60)]
    chunks = spark.createDataFrame(said, "id int, text string").coalesce(1)
    rows = [(k, j, [float(x) for x in v]) for k, m in REFERENCES.items() for j, v in enumerate(I.letter_count_matrix(m))]
    pack = I.IntentPack.from_rows(spark.createDataFrame(rows, "intent string, j int, vec array<float>"), "intent", "j", "vec")
    assert all(matrix.dtype == np.float32 for _, _, matrix, _ in pack.blocks(60))
    found = I.intent_distances(chunks, "text", pack, "all", batch_encoder=lambda: I.letter_count_matrix).select("*", F.spark_partition_id().alias("part")).collect()
    assert len({r["part"] for r in found}) > 1 and sorted(r["id"] for r in found) == list(range(60))
    small = I.IntentPack.encode(REFERENCES, I.letter_count_matrix)
    for r in found:
        unit = I._unit_rows(I.letter_count_matrix([said[r["id"]][1]]))
        assert r["a"] == pytest.approx(list(1 - (unit @ small.vectors["a"].T)[0]), abs=1e-12)


def test_opposed_score(spark, make):
    row = make([(0.1, 0.6)], "p double, n double")
    assert row.select(I.opposed_score(F.col("p"), F.col("n"))).first()[0] == pytest.approx(0.25)
    pack = I.OpposedPack.encode({"x": ["aaa/zzz", "bbb/yyy"]}, I.letter_count_matrix)
    rows = spark.createDataFrame([("c", 0, "aaaaaaaa"), ("c", 1, "tiny"), ("c", 2, "zzzzzzz.bbbbbbbb")], CHUNKS)
    for how, want in (("all", [[0.0, 0.5], [0.5, 0.5], [1.0, 0.0]]), ("min", [0.0, 0.5, 0.0])):
        for encoder in ({"column_encoder": I.letter_counts}, {"batch_encoder": letters}):
            found = I.opposed_distances(rows, "text", pack, how, **encoder).orderBy("chunk_id")
            got = [r["x"] for r in found.collect()]
            if how == "min":
                want = [0.0, 0.5, 0.5]
            assert np.allclose(got, want), (how, encoder)


def test_encoders_agree(spark):
    pack = I.IntentPack.encode({"move": fv.MOVE_SENTENCES}, I.letter_count_matrix)
    texts = ["we are moving, next month; ok", "", "short", "first part here.second part there", None]
    rows = spark.createDataFrame([("c", i, t) for i, t in enumerate(texts)], CHUNKS)
    a = I.intent_distances(rows, "text", pack, column_encoder=I.letter_counts)
    b = I.intent_distances(rows, "text", pack, batch_encoder=letters)
    a, b = ([r["move"] for r in x.orderBy("chunk_id").collect()] for x in (a, b))
    assert np.allclose(a, b) and a[1] == a[2] == [1.0] * 26
    with pytest.raises(ValueError):
        I.intent_distances(rows, "text", pack)


def test_vectors_of_texts(spark):
    rows = spark.createDataFrame([("c", 0, "a b"), ("c", 1, "a b"), ("c", 2, "c"), ("c", 3, None)], CHUNKS)
    for made in (I.encode_texts(rows, "text", I.hashed_words(16)), I.encode_hashed(rows, "text", 16)):
        got = [r["vec"] for r in made.orderBy("chunk_id").collect()]
        assert got[0] == got[1] != got[2] and sum(got[0]) == 2 and sum(got[3]) == 0
    unit = I.encode_hashed(rows, "text", 16, unit=True).orderBy("chunk_id").first()["vec"]
    assert abs(sum(x * x for x in unit) - 1) < 1e-6


def test_vocabulary_and_padding(spark):
    rows = [(0, ["b", "a", "c"]), (1, ["a", "b"]), (2, []), (3, ["d"] * 20)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    vocab = {r["token"]: r["id"] for r in LX.vocabulary(df, "id", "tokens").collect()}
    assert vocab == {"d": 2, "b": 3, "a": 4, "c": 5}
    named = df.withColumn("id", F.col("id").cast("string"))
    assert {r["token"]: r["id"] for r in LX.vocabulary(named, "id", "tokens").collect()} == vocab
    known = LX.vocabulary(df, "id", "tokens").filter("token <> 'c'")
    got = {r["id"]: r["ids"] for r in LX.padded_ids(df, "id", "tokens", known, 4).collect()}
    assert got == {0: [3, 4, 1, 0], 1: [4, 3, 0, 0], 2: [0] * 4, 3: [2] * 4}


def test_collocations(spark):
    rows = [(i, ["new", "york", "is", "big", f"w{i}"]) for i in range(30)]
    rows += [(100 + i, ["is", f"v{i}", "big"]) for i in range(30)] + [(200, []), (201, ["new", "york", "york"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    merged, pairs, _ = LX.detect_collocations(df, "id", "tokens", threshold=4.0)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {("new", "york")}
    n_ab, n_a, n_b = 31, 31, 32
    words = 4 + 60
    distinct_pairs = 3 + 30 + 60 + 1
    assert pairs.first()["score"] == pytest.approx((n_ab - 5) * (words + distinct_pairs) / (n_a * n_b))
    got = {r["id"]: r["tokens"] for r in merged.collect()}
    assert got[200] == [] and got[201] == ["new york", "york"] and got[0][0] == "new york"


def test_collocations_keep_one_copy_of_the_text(spark):
    """Of what is staged on the way only the pairs, the triples and the text merged once are left."""
    df = spark.createDataFrame([(i, ["new", "york", "is", f"w{i}"]) for i in range(30)], "id long, tokens array<string>")
    before = staged(spark)
    merged, pairs, triples = LX.detect_collocations(df, "id", "tokens", threshold=1.0)
    left = [path for path in staged(spark) if path not in before and os.path.exists(path.removeprefix("file:"))]
    assert len(left) == 3 and merged.count() == 30 and pairs.count() > 0 and triples.count() >= 0


def test_merging_is_greedy_from_the_left(spark):
    df = spark.createDataFrame([(1, ["a", "a", "a", "b", "a", "a"])], "id long, tokens array<string>")
    pairs = spark.createDataFrame([("a", "a")], "a string, b string")
    got = LX.merge_pairs(df.withColumn("other", F.lit(1)), "id", "tokens", pairs).first()
    assert got["tokens"] == ["a a", "a", "b", "a a"] and got["other"] == 1


def test_embedding_rows(spark):
    vocab = spark.createDataFrame([("x", 3, 2), ("y", 1, 3)], "token string, count long, id long")
    vectors = spark.createDataFrame([("x", [1.0, 2.0])], "word string, vector array<double>")
    got = {r["id"]: r["vector"] for r in LX.embedding_rows(vocab, vectors, 2).collect()}
    assert got == {0: [0.0, 0.0], 1: [0.0, 0.0], 2: [1.0, 2.0], 3: [0.0, 0.0]}


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(80):
        y = i % 2
        x = rng.normal(size=3) + (3 if y else -3)
        rows.append((i, [float(v) for v in x], y))
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    return df.withColumn("features", array_to_vector("x")).coalesce(2).persist()


def newton(x, y, c):
    """Minimum of the summed logistic loss plus half the squared norm over C."""
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0 / c] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
    return w


def test_logistic_objective(separable):
    rows = separable.collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    fitted = L.LogisticClassifier(["a", "b", "c"], tol=1e-10).fit(separable).model
    got = [*fitted.coefficients, fitted.intercept]
    assert got == pytest.approx(list(newton(x, y, 1.0)), abs=1e-4)


def test_fit_predict_store(separable, tmp_path):
    model = L.LogisticClassifier(["a", "b", "c"])
    with pytest.raises(ValueError):
        model.predict(separable)
    scored = model.fit(separable).predict(separable)
    assert L.accuracy(scored, "label", "prediction").first()["accuracy"] == 1.0
    matrix = {r["label"]: (r["0"], r["1"]) for r in L.confusion(scored, "label", "prediction").collect()}
    assert matrix == {0: (40, 0), 1: (0, 40)}
    found = model.evaluate(separable, separable)
    assert found["train_accuracy"] == 1.0 and found["test_cm"][(0, 0)] == 40
    sinks.save_model(model.model, str(tmp_path / "m"))
    again = sinks.load_model(LogisticRegressionModel, str(tmp_path / "m"))
    assert again.coefficients == model.model.coefficients
    by_hand = separable.select(
        "id", L.logistic_score(F.col("x"), list(again.coefficients), again.intercept).alias("p")
    ).join(scored.select("id", "detection_score"), "id")
    assert all(abs(r["p"] - r["detection_score"]) < 1e-9 for r in by_hand.collect())


def test_grid_keeps_the_first_of_equals(separable):
    grid = {"tol": [0.001, 0.0001], "C": [5.0, 0.1], "max_iter": [100]}
    model, log = L.fit_best(separable, separable, ["a", "b", "c"], grid)
    assert [r["params"] for r in log.collect()][:2] == [
        "tol=0.001,C=5.0,max_iter=100", "tol=0.001,C=0.1,max_iter=100",
    ]
    assert (model.params["tol"], model.params["C"]) == (0.001, 5.0)
    assert len(L.parameter_grid()) == 30


def test_classifiers_share_a_pass(separable, monkeypatch):
    """Counts of each one are those of its own predictions, also where a pass ends between them."""
    monkeypatch.setattr(L, "_AT_ONCE", 2)
    rows = separable.withColumn("label", F.when(F.col("id") < 9, 1 - F.col("label")).otherwise(F.col("label")))
    models = [L.LogisticClassifier(["a", "b", "c"], C=c, max_iter=n).fit(rows) for c, n in ((5.0, 9), (1e-6, 1), (0.1, 2))]
    train, test = rows.filter("id >= 30"), rows.filter("id < 30")
    for model, found in zip(models, L.evaluate_all(models, train, test), strict=True):
        for name, part in (("train", train), ("test", test)):
            scored = model.predict(part)
            assert found[f"{name}_accuracy"] == pytest.approx(L.accuracy(scored, "label", "prediction").first()[0])
            matrix = {(r["label"], j): r[str(j)] for r in L.confusion(scored, "label", "prediction").collect() for j in (0, 1)}
            assert found[f"{name}_cm"] == matrix


def test_rows_of_a_fit_are_spread(spark):
    """One part goes to all cores, with the same rows."""
    rows = L.spread(spark.range(400).coalesce(1))
    assert len(rows.inputFiles()) == spark.sparkContext.defaultParallelism > 1
    assert sorted(r["id"] for r in rows.collect()) == list(range(400))


def test_features_are_worked_out_once_for_a_training(spark, tmp_path):
    """The split, the fits and the stored rows read one copy, and chunks that come twice are in one part each."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(n):
        seen.add(1)
        return n

    rows = [(f"c{i // 4 % 10}", "0", 10 + i, 0.1 * (i % 7), [float(i % 3), 1.0], int(i % 2)) for i in range(200)]
    columns = "conv_id string, chunk_id string, sntce_len int, rel_pos_sntce double, intent array<double>, label int"
    features = spark.createDataFrame(rows, columns).withColumn("sntce_len", counted("sntce_len"))
    jobs.train_and_store(features, 2, str(tmp_path), grid={"C": [1.0, 0.1]})
    assert seen.value == 200
    stored = spark.read.parquet(f"{tmp_path}/data")
    assert sorted(r["features"][0] for r in stored.collect()) == [10.0 + i for i in range(200)]
    assert stored.filter("part = 'test'").count() == 30


def test_boosted_trees(separable):
    model = L.BoostedTrees(["a", "b", "c"], maxIter=3).fit(separable)
    assert L.accuracy(model.predict(separable), "label", "prediction").first()[0] == 1.0
    assert model.importance(separable).count() == 3


def test_text_network(spark):
    rows = [(i, "we are moving soon" if i % 2 else "please fix the bill", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string, label double")
    model = L.text_classifier(features=64, max_iter=30).fit(df)
    assert L.accuracy(L.predict_text(model, df), "label", "prediction").first()[0] == 1.0


def _held_out_accuracy(model, rows):
    return rows.sparkSession.createDataFrame(
        [(r["label"], r["prediction"]) for r in L.predict_text(model, rows).collect()], "label double, prediction double"
    ).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def _order_task(rng, n):
    """1 where "not" stands right before "good": texts of both classes hold the same words."""
    rows = []
    for i in range(n):
        fill = [f"w{k}" for k in rng.integers(0, 12, 6)]
        at, label = int(rng.integers(0, 6)), float(i % 2)
        fill[at:at] = ["not", "good"] if label else ["good", "not"]
        rows.append((i, " ".join(fill), label))
    return rows


def _either_task(rng, n):
    """1 where exactly one of two words occurs: no sum of weights can tell."""
    rows = []
    for i in range(n):
        a, b = i % 2, i // 2 % 2
        words = ["left" if a else "here", "right" if b else "there", f"w{rng.integers(0, 3)}"]
        rows.append((i, " ".join(words), float(a != b)))
    return rows


@pytest.mark.parametrize("task, settings", [(_order_task, {}), (_either_task, {"reach": 0})])
def test_text_network_beats_a_regression_over_words(spark, task, settings):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    rng = np.random.default_rng(8)
    schema = "id long, text string, label double"
    train, test = (spark.createDataFrame(task(rng, n), schema) for n in (400, 200))
    network = L.text_classifier(features=256, **settings).fit(train)
    plain = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\s+"),
            HashingTF(inputCol="_words", outputCol="features", numFeatures=256),
            LogisticRegression(regParam=0.001),
        ]
    ).fit(train)
    by_words = plain.transform(test).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    by_network = _held_out_accuracy(network, test)
    assert by_network > 0.9 and by_network > by_words + 0.2


def test_text_network_takes_empty_texts(spark):
    rows = [(i, "" if i % 3 == 0 else "we are moving", float(i % 3 != 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string, label double")
    assert _held_out_accuracy(L.text_classifier(features=32, max_iter=30).fit(df), df) == 1.0


def test_annotations(spark):
    rows = [("a", 1, "s1", "N", 0), ("a", 1, "s2", "Y", 1), ("a", 2, "s3", None, 2), ("b", 7, "s4", "N", 3)]
    df = spark.createDataFrame(rows, "conv_id string, chunk_id long, sntnce string, label string, ord long")
    said, labels = X.clean_annotations(df, "ord")
    assert said.count() == 3
    assert {(r[0], r[1]): r["label"] for r in labels.collect()} == {("a", "1"): 1, ("b", "7"): 0}


def test_split_sizes(spark):
    train, test = X.split_rows(spark.range(101), 0.15, O.mixed(F.col("id")), O.MIXED_RANGE, ["id"])
    assert (train.count(), test.count()) == (85, 16)
    rows = spark.range(100).withColumn("conv_id", (F.col("id") % 10).cast("string"))
    train, test = X.split_conversations(rows, 0.15, O.mixed(F.col("conv_id")), O.MIXED_RANGE)
    assert (train.count(), test.count()) == (80, 20)


# --- whole jobs, with one conversation that holds a third of the sentences -------------

WEIGHTS, INTERCEPT = [0.01, 0.5, *[-1.0] * 26], 20.0


@pytest.fixture(scope="module")
def long_talk(spark):
    phrases = ["im moving next month", "hello", "it is fine", "moving it now", "yes", "thank you"]
    rows = [("big", phrases[i % 6], i, "END_USER") for i in range(600)]
    rows += [(f"c{c}", phrases[(c + i) % 6], i, "AGENT" if i % 3 == 2 else "END_USER") for c in range(100) for i in range(12)]
    rows += [("calls off", "please cancel.", 0, "AGENT"), ("calls off", "im moving next month", 9, "END_USER")]
    return spark.createDataFrame(rows, f"{ID} string, sntnce string, sntnce_ts long, sntnce_partcpnt_role string")


def test_classifier_detection_does_not_depend_on_the_plan(spark, long_talk):
    pack = I.IntentPack.encode({"move": fv.MOVE_SENTENCES}, I.letter_count_matrix)
    scorer = jobs.weights_scorer(WEIGHTS, INTERCEPT)
    results = []
    for partitions, large in (("4", False), ("13", True), ("1", True)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found = jobs.detect_classified(long_talk, pack, scorer, large_keys=large, column_encoder=I.letter_counts)
        results.append(sorted((r[0], round(r[1], 9)) for r in found.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
    names = [r[0] for r in results[0]]
    assert "big" in names and "calls off" not in names and len(names) > 50


def test_naive_detection_is_a_subset_of_movers(long_talk):
    found = jobs.detect_naive(long_talk).select(F.col("conv_id").alias(ID))
    movers = long_talk.filter(rules.mover_candidate(F.col("sntnce"), F.col("sntnce_partcpnt_role")))
    assert found.join(movers, ID, "left_anti").count() == 0
    _, stats = jobs.detect_all(long_talk, jobs.detect_naive)
    assert stats.first()["n_total"] == 102


def test_training_job(spark):
    rows = []
    for i in range(60):
        text = "im moving next month" if i % 2 else "house hunting is something that they said moving a lot to aaaaaa"
        rows.append((f"c{i}", str(i), text, "Y" if i % 2 else "N", i))
    df = spark.createDataFrame(rows, "conv_id string, chunk_id string, sntnce string, label string, ord long")
    pack = I.IntentPack.encode({"move": fv.MOVE_SENTENCES}, I.letter_count_matrix)
    features = jobs.training_features(df, "ord", pack, column_encoder=I.letter_counts)
    assert features.count() == 60
    model, log, train, test = jobs.train(features, 26, grid=None)
    assert test.count() == 9 and log.count() == 1
    assert L.accuracy(model.predict(test), "label", "prediction").first()[0] == 1.0
    scored = jobs.classifier_scorer(model, 26)(features.drop("label"))
    assert scored.filter("detection_score > 0.5").count() == 30


# --- word vectors as tables -----------------------------------------------------------------


def _information(texts, window, shift=1.0):
    n = {}
    for words in texts:
        for i, a in enumerate(words or []):
            for b in words[i + 1 : i + 1 + window]:
                n[a, b] = n.get((a, b), 0) + 1
                n[b, a] = n.get((b, a), 0) + 1
    of = {}
    for (a, _), k in n.items():
        of[a] = of.get(a, 0) + k
    total = sum(of.values())
    value = {p: math.log(k * total / (of[p[0]] * of[p[1]])) - math.log(shift) for p, k in n.items()}
    return {p: v for p, v in value.items() if v > 0}


def _texts(words, rows, longest, seed=3):
    rng = np.random.default_rng(seed)
    return [[f"w{i}" for i in rng.integers(0, words, rng.integers(0, longest))] for _ in range(rows)]


@pytest.mark.parametrize("window", [1, 3])
def test_pair_information_matches_a_loop(spark, monkeypatch, window):
    monkeypatch.setattr(WV, "_PIECE", 5)
    texts = [*_texts(9, 30, 23), [], None, ["alone"], ["w1"] * 12]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    found = WV.pair_information(WV.pair_counts(df, "tokens", window), 1.2).collect()
    expected = _information(texts, window, 1.2)
    assert {(r["word"], r["context"]) for r in found} == set(expected)
    assert all(r["value"] == pytest.approx(expected[r["word"], r["context"]]) for r in found)


@pytest.mark.parametrize("block", [4, 100])
def test_vectors_give_the_matrix_back(spark, block):
    """With as many dimensions as words, products of vectors are the matrix with its eigenvalues' sizes."""
    texts = [*_texts(11, 20, 9), ["alone"]]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    found = {r["word"]: np.array(r["vector"]) for r in WV.word_vectors(df, "tokens", width=14, window=2, rounds=2, block=block).collect()}
    names = sorted(found)
    entries = _information(texts, 2)
    matrix = np.array([[entries.get((a, b), 0.0) for b in names] for a in names])
    values, turned = np.linalg.eigh(matrix)
    vectors = np.array([found[a] for a in names])
    assert "alone" in names and not found["alone"].any()
    assert np.allclose(vectors @ vectors.T, turned * np.abs(values) @ turned.T, atol=1e-6)


def test_words_in_equal_places_are_neighbours(spark):
    rng = np.random.default_rng(5)
    twins, fill = [("car", "auto"), ("house", "home")], [f"f{i}" for i in range(40)]
    near = {w: fill[10 * k : 10 * k + 10] for k, pair in enumerate(twins) for w in pair}
    texts = []
    for word, around in near.items():
        for _ in range(60):
            a, b, c, d = rng.choice(around, 4)
            texts.append(([a, b, word, c, d],))
    df = spark.createDataFrame(texts, "tokens array<string>")
    rows = WV.word_vectors(df, "tokens", width=8, window=2, rounds=4).collect()
    found = {r["word"]: np.array(r["vector"]) / (np.linalg.norm(r["vector"]) or 1) for r in rows}
    for a, b in twins:
        others = {w: found[w] @ found[a] for w in near if w != a}
        assert max(others, key=others.get) == b


def test_word_vectors_keep_neither_counts_nor_matrix(spark):
    """Pairs, totals and the matrix are deleted once nothing reads them: the numbered words and the basis are left."""
    before = staged(spark)
    found = WV.word_vectors(spark.createDataFrame([(t,) for t in _texts(11, 20, 9)], "tokens array<string>"), "tokens", width=4, rounds=1)
    left = [path for path in staged(spark) if path not in before and os.path.exists(path.removeprefix("file:"))]
    assert not any({"context"} & set(spark.read.parquet(path).columns) or "at" in spark.read.parquet(path).columns for path in left)
    assert found.count() > 0


def test_no_texts_have_no_vectors(spark):
    df = spark.createDataFrame([(None,), ([],)], "tokens array<string>")
    assert WV.word_vectors(df, "tokens", width=3, rounds=1).collect() == []


def test_word_vectors_learn_on_all_cores(spark, monkeypatch):
    """Rows of one partition are learned from in as many parts as there are cores."""
    import pyspark.ml.feature

    given = {}

    class Recorder:
        def __init__(self, **settings):
            given.update(settings)

        def fit(self, df):
            return None

    monkeypatch.setattr(pyspark.ml.feature, "Word2Vec", Recorder)
    LX.fit_word_vectors(spark.createDataFrame([(["a", "b"],)], "tokens array<string>").coalesce(1), "tokens")
    assert given["numPartitions"] == spark.sparkContext.defaultParallelism


def test_pair_information_brings_the_counts_and_counts_once(spark, monkeypatch):
    """What is read several times is staged, and nobody has to join the counts again."""
    written = []
    monkeypatch.setattr(WV, "stage", lambda df: written.append(df.columns) or stage(df))
    df = spark.createDataFrame([(t,) for t in _texts(9, 30, 23)], "tokens array<string>")
    pairs = WV.pair_counts(df, "tokens", 2)
    counts = {(r["word"], r["context"]): r["n"] for r in pairs.collect()}
    assert all(counts[r["word"], r["context"]] == r["n"] for r in WV.pair_information(pairs).collect())
    assert ["word", "context", "n"] in written


@pytest.mark.parametrize("block,groups", [(2, 2), (4, 16)])
def test_images_are_products_of_the_matrix(spark, monkeypatch, block, groups):
    monkeypatch.setattr(WV, "ROW_BLOCKS", groups)
    entries = _information(_texts(11, 20, 9), 2)
    names = sorted({a for a, _ in entries})
    rng = np.random.default_rng(2)
    given = {w: rng.normal(size=3) for w in [*names, "alone"]}
    information = spark.createDataFrame([(a, b, v) for (a, b), v in entries.items()], "word string, context string, value double")
    vectors = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in given.items()], "word string, vector array<double>")
    found = {r["word"]: r["image"] for r in WV.with_images(information, vectors, block).collect()}
    assert set(found) == set(given) and found["alone"] is None
    for a in names:
        assert found[a] == pytest.approx(sum(v * given[c] for (w, c), v in entries.items() if w == a))
