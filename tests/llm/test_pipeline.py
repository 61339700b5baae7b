import random
import zlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

LANGS = {"en": ["the", "and", "with", "thing", "shall", "this"], "de": ["der", "und", "mit", "nicht", "schön", "auch"]}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size int, _others int"


def documents():
    random.seed(12)
    rows = []
    for i in range(700):
        lang = random.choice(list(LANGS))
        words = [random.choice(LANGS[lang]) + str(random.randrange(300)) for _ in range(random.randint(10, 60))]
        toxic = i % 6 == 0
        for _ in range(4 if toxic else 0):
            words.insert(random.randrange(len(words)), random.choice(["idiot", "scum"]))
        rows.append([i, " ".join(words), lang, random.choice(["a", "b", None, "hot", "hot"]), toxic])
    for i in range(100):  # copies, some with one word more
        rows.append([1000 + i, rows[i * 5][1] + (" more" if i % 2 else ""), *rows[i * 5][2:]])
    rows += [[2000, None, "en", "a", False], [2001, "", None, None, False], [2002, "123 --- 456", "en", "a", False]]
    rows.append([None, "this text has no id and 7 words", "en", "a", False])
    rows.append(list(rows[1]))  # a repeated row
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("corpus"))
    rows = documents()
    spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", 1, 2) for i, t, lang, s, _ in rows], SCHEMA).write.parquet(f"{place}/documents.parquet")
    labels = [(i, 1, int(toxic)) for i, _, _, _, toxic in rows if i is not None and i < 700]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_each_stage_does_its_work(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = rows.columns, [rows]
    for name, function in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.stored(spark, function(spark, kept[-1], folder)))
        if name != "byte_bpe":
            assert kept[-1].columns == names
    every, told, clean, single, mixed, tokens = ([r.asDict() for r in k.collect()] for k in kept)
    assert {r["doc_id"] for r in every} - {r["doc_id"] for r in told} == {2000, 2001, 2002}
    toxic = {i for i, _, _, _, bad in documents() if bad}
    gone = {r["doc_id"] for r in told} - {r["doc_id"] for r in clean}
    assert gone <= toxic and len(gone) >= 0.95 * len(toxic - {2000, 2001, 2002})
    held_out = {i for i in toxic if zlib.crc32(str(i).encode()) % 3 == 1}
    assert held_out & gone
    sets = [(r["doc_id"], shingles(r["text"])) for r in clean if r["doc_id"] is not None]
    least = {i: i for i, _ in sets}
    for _ in range(3):
        for x, (a, s) in enumerate(sets):
            for b, t in sets[:x]:
                if 100 * len(s & t) >= 75 * len(s | t):
                    least[a] = least[b] = min(least[a], least[b])
    assert sorted(r["doc_id"] for r in single if r["doc_id"] is not None) == sorted(set(least.values()))
    assert sum(r["doc_id"] is None for r in single) == 1
    words = lambda rs: sum(len(r["text"].split()) for r in rs)
    assert abs(words(mixed) - words(single)) < 200
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single}
    assert all(sum(r["doc_id"] == i for r in mixed) <= 3 for i in {r["doc_id"] for r in mixed})
    assert sorted(str(r["doc_id"]) for r in tokens) == sorted(str(r["doc_id"]) for r in mixed)
    import hashlib

    digests = sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed)
    assert sorted(r["decoded_sha256"] for r in tokens) == digests
    assert all(r["n_tokens"] == len(r["ids"]) for r in tokens)


def test_repeated_and_null_ids_are_deduplicated_by_text(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcd"}
    rows = [(7, "a"), (7, "b"), (1, "a"), (3, "b"), (7, "c"), (7, "c"), (None, "d"), (None, "d"), (None, "a")]
    docs = spark.createDataFrame([(i, texts[k], "en", "s", 1, "x", 1, 2) for i, k in rows], SCHEMA)
    kept = dict(corpus_pipeline.STAGES)["minhash_dedup"](spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r["text"][0], r["doc_id"]) for r in kept.collect())
    assert got == [("a", 1), ("b", 3), ("c", 7), ("d", None)]


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
