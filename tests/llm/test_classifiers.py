import math
import random

import numpy as np
import pyarrow as pa

from callsift.llm import language_id, toxicity
from callsift.llm.words import NOT_ALPHANUMERIC, WHITE_SPACE, word_hashes

WORDS = {"en": ["the", "and", "with", "thing", "shall"], "de": ["der", "und", "mit", "nicht", "schön"], "fr": ["le", "et", "avec", "être", "ça"]}


def sentences(n, seed):
    random.seed(seed)
    rows = []
    for i in range(n):
        lang = random.choice(list(WORDS))
        rows.append((i, " ".join(random.choices(WORDS[lang], k=random.randint(3, 30))), lang))
    return rows


def test_word_hashes_know_words_and_texts():
    texts = pa.array(["a b", None, "", "b  a\n", "ab", "B", " "])
    hashes, counts = word_hashes(texts, WHITE_SPACE)
    assert counts.tolist() == [2, 0, 0, 2, 1, 1, 0]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] == hashes[5]
    assert len(set(hashes.tolist())) == 3
    assert word_hashes(pa.array(["x", "idiot%%% IDIOT!! é"]).slice(1), NOT_ALPHANUMERIC)[1].tolist() == [3]
    assert word_hashes(pa.array(["ab", "cd"]), WHITE_SPACE)[1].tolist() == [1, 1]


def test_languages(make):
    rows = sentences(400, 1)
    train = make(rows + [(1000, None, "en"), (1001, "text", None)], "doc_id long, text string, lang string")
    model = language_id.fit(train, "text", "lang")
    assert model.langs == ("de", "en", "fr")
    odd = [(i, t, "x", 9) for i, t in enumerate([None, "", "12 34 --", "  ", "é"])]
    test = make([(100 + i, t, lang, 1) for i, t, lang in sentences(300, 2)] + odd, "doc_id long, text string, lang_pred string, _n int")
    got = {r["doc_id"]: r for r in language_id.predict(test, "text", model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 for i in range(4))
    assert got[4]["lang_pred"] in model.langs
    right = [got[100 + i]["lang_pred"] == lang for i, _, lang in sentences(300, 2)]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_counts_match_a_loop(make):
    settings = language_id.Settings(orders=(1, 2), buckets=64)
    rows = [("Ab ü", "x"), ("", "x"), ("b", "y"), ("z" * 5000, "y")]
    counted = language_id.count_grams(make(rows, "text string, lang string"), "text", "lang", settings).collect()
    grams = {"x": 0, "y": 0}
    for text, lang in rows:
        padded = len(f" {text} ")
        grams[lang] += padded + padded - 1
    for lang, n in grams.items():
        assert sum(r["n"] for r in counted if r["lang"] == lang) == n


def plain_grams(text, settings):
    """Buckets of n-grams, from the points of the text one by one."""
    whole = 1 << 64

    def finish(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % whole
        x = (x ^ x >> 27) * 0x94D049BB133111EB % whole
        return x ^ x >> 31

    points = [finish(ord(c) + 1) for c in f" {text.lower()} "]
    for n in settings.orders:
        for i in range(len(points) - n + 1):
            rolled = 0
            for x in points[i : i + n]:
                rolled = (rolled * 0x9E3779B97F4A7C15 + x) % whole
            yield finish((rolled + n) % whole) % settings.buckets


def plain_languages(rows, texts, settings):
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            mine = counts.setdefault(lang, [settings.smoothing] * settings.buckets)
            for b in plain_grams(text, settings):
                mine[b] += 1
    for text in texts:
        if text is None or not any(c.isalpha() for c in text):
            yield "und", 0.0
            continue
        logs = {lang: sum(math.log(mine[b] / sum(mine)) for b in plain_grams(text, settings)) for lang, mine in counts.items()}
        best = max(sorted(logs), key=logs.__getitem__)
        yield best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())


def test_languages_match_plain_python(make, monkeypatch):
    monkeypatch.setattr(language_id, "WINDOW", 7)
    settings = language_id.Settings(orders=(1, 3), buckets=128)
    rows = [(t, lang) for _, t, lang in sentences(40, 5)] + [("b", "tie"), ("b", "also"), (None, "en"), ("x", None), ("", "nothing")]
    texts = [t for _, t, _ in sentences(25, 6)] + ["b", None, "", "12", "ü", "long " * 300, "İstanbul"]
    table = make([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for cells in (128 * 100, 128 * 2, 1):
        some = language_id.Settings(orders=(1, 3), buckets=128, most_cells=cells)
        model = language_id.fit(make(rows, "text string, lang string"), "text", "lang", some)
        assert model.langs == ("also", "de", "en", "fr", "nothing", "tie")
        got = sorted(language_id.predict(table, "text", model).collect())
        for r, (lang, score) in zip(got, plain_languages(rows, texts, settings), strict=True):
            assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3, (r, lang, score)


def test_a_very_long_text(make):
    rows = [(t, lang) for _, t, lang in sentences(100, 7)]
    model = language_id.fit(make(rows, "text string, lang string"), "text", "lang")
    long = "the thing shall and with " * 60_000
    got = language_id.predict(make([(1, long), (2, "der und mit nicht")], "id long, text string"), "text", model).collect()
    assert [(r["id"], r["lang_pred"]) for r in sorted(got)] == [(1, "en"), (2, "de")]
    hashes, counts = word_hashes(pa.array([long + "ende", "ende", "x" * 2_500_000 + " ende"]), WHITE_SPACE)
    assert counts.tolist() == [300_001, 1, 2] and hashes[300_000] == hashes[300_001] == hashes[300_003]


def test_nothing_learned(make):
    model = language_id.fit(make([], "text string, lang string"), "text", "lang")
    assert language_id.predict(make([("word",)], "text string"), "text", model).first()["lang_pred"] == "und"


def test_held_out_is_crc32_of_the_id_as_text(make):
    import zlib

    rows = make([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = rows.select("doc_id", language_id.held_out(rows.doc_id, 4, 2).alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_toxicity(make):
    random.seed(4)
    calm = [f"w{i}" for i in range(200)]
    rude = ["idiot", "moron", "scum"]

    def text(toxic):
        words = random.choices(calm, k=random.randint(5, 120))
        for _ in range(3 if toxic else 0):
            words.insert(random.randrange(len(words)), random.choice(rude) + random.choice(["", ",", "%%%"]))
        return " ".join(words)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(1500)]
    documents = make([(i, t, "x") for i, t, _ in rows] + [(None, "idiot", "x"), (9000, None, "x"), (9001, "", "x"), (9002, "IDIOT! scum", "x")], "doc_id long, text string, score string")
    labels = make([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (8000, 1), (9001, None)], "doc_id long, toxic int")
    model = toxicity.fit(documents, labels, "doc_id", "text", "toxic")
    assert 0 < len(model.weights) < 4000
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents, "text", model).collect()}
    held = [(got[i] >= 0.7) == bool(y) for i, _, y in rows if i % 3 == 0]
    assert np.mean(held) > 0.97
    assert got[9000] == got[9001] < 0.5 and got[9002] > 0.7
    again = toxicity.fit(documents, labels, "doc_id", "text", "toxic")
    assert again.weights == model.weights


def test_toxicity_without_labels(make):
    model = toxicity.fit(make([(1, "a")], "doc_id long, text string"), make([], "doc_id long, toxic int"), "doc_id", "text", "toxic")
    assert toxicity.score(make([("a",), (None,)], "text string"), "text", model).first()["score"] == 0.5


def plain_ftrl(rows, settings):
    """The weights after on-line learning, one coordinate after the other."""
    z, n = {}, {}

    def weight(i):
        lean = abs(z.get(i, 0.0)) - (0 if i == settings.features else settings.l1)
        return 0.0 if lean <= 0 else -math.copysign(lean, z[i]) / ((settings.beta + math.sqrt(n.get(i, 0.0))) / settings.alpha + settings.l2)

    for epoch in range(settings.epochs):
        for at in np.random.default_rng(settings.seed + epoch).permutation(len(rows)):
            found, label = rows[at]
            touched = [*found, settings.features]
            before = {i: weight(i) for i in touched}
            gradient = 1 / (1 + math.exp(-sum(before.values()))) - label
            for i in touched:
                rate = (math.sqrt(n.get(i, 0.0) + gradient**2) - math.sqrt(n.get(i, 0.0))) / settings.alpha
                z[i] = z.get(i, 0.0) + gradient - rate * before[i]
                n[i] = n.get(i, 0.0) + gradient**2
    return {i: w for i in z if (w := weight(i))}


def test_toxicity_matches_a_plain_loop(make):
    from pyspark.sql import functions as F

    random.seed(8)
    settings = toxicity.Settings(features=1 << 12, l1=0.5, epochs=3)
    texts = [(i, " ".join(random.choices(["a", "b", "c", "idiot", "d", "e"], k=random.randint(0, 9))), random.randint(0, 1)) for i in range(60)]
    documents = make([(i, t) for i, t, _ in texts], "id long, text string")
    labels = make([(i, y) for i, _, y in texts], "id long, y int")
    model = toxicity.fit(documents, labels, "id", "text", "y", settings)
    ordered = documents.orderBy(F.xxhash64(F.lit(settings.seed + 1), "id")).collect()
    truth = {i: y for i, _, y in texts}
    rows = [(toxicity.features(pa.array([r["text"]]), settings)[0].tolist(), truth[r["id"]]) for r in ordered]
    want = plain_ftrl(rows, settings)
    assert abs(model.intercept - want.pop(settings.features)) < 1e-9
    assert model.weights.keys() == want.keys() and len(want) > 5
    assert all(abs(model.weights[i] - w) < 1e-9 for i, w in want.items())
    # features of a text, by a plain loop over its words
    words = texts[3][1].split()
    pairs = {(words[i], words[i + k], k) for k in settings.skips for i in range(len(words) - k)}
    assert len(toxicity.features(pa.array([texts[3][1]]), toxicity.Settings())[0]) == len(set(words)) + len(pairs)


def test_toxicity_learns_from_a_bounded_sample(make):
    documents = make([(i, "idiot scum" if i % 2 else "fine day") for i in range(40)] + [(99, " ".join(f"w{i}" for i in range(50_000)))], "id long, text string")
    labels = make([(i, i % 2) for i in range(40)] + [(99, 0)], "id long, y int")
    model = toxicity.fit(documents, labels, "id", "text", "y", toxicity.Settings(most_found=60, l1=0.0))
    assert 0 < len(model.weights) <= 6
    got = {r["id"]: r["score"] for r in toxicity.score(documents, "text", model).collect()}
    assert got[1] > 0.5 > got[0] and 0 <= got[99] <= 1
