import random

import numpy as np
import pytest

from callsift.llm import fingerprints, minhash_dedup, vector_dedup
from callsift.llm.components import connected


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(make):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(random.randrange(3000, 3200), random.randrange(3000, 3200)) for _ in range(120)]
    edges += [(5, 5), (None, 3), (7, 6), (7, 6)]
    got = {r["node"]: r["component"] for r in connected(make(edges, "a long, b long"), "a", "b").collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == roots({n for e in real for n in e}, real)
    assert connected(make([], "a long, b long"), "a", "b").collect() == []


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    edges = [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, t in sets[:x]
        if None not in (a, b) and a != b and s and t and 100 * len(s & t) >= 75 * len(s | t)
    ]
    return roots({i for i, _ in rows if i is not None}, edges)


def test_near_duplicates_match_brute_force(make):
    random.seed(7)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(40):
        base = random.choices(words, k=random.randint(8, 120))
        for _ in range(random.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4])):
                copy[random.randrange(len(copy))] = random.choice(words)
            rows.append((i * 3 % 997, " ".join(copy)))
            i += 1
    shared = " ".join(random.choices(words, k=60))
    rows += [(2000 + k, shared + " " + " ".join(random.choices(words, k=40))) for k in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "one two"), (3004, "ONE  two"), (3005, "one"), (None, "one two"), (None, None)]
    rows += [(4000, shared)] * 2 + [(4001, shared.upper()), (4002, shared.replace(" ", "\t"))]
    df = make([(a, t, "x") for a, t in rows], "doc_id long, text string, component_id string")
    got = minhash_dedup.near_duplicates(df, "doc_id", "text").collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert sorted(r["n_shingles"] for r in got) == sorted(len(shingle_set(t)) for _, t in rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_one_key_with_two_texts(make):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = make([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    got = {r["component_id"] for r in minhash_dedup.near_duplicates(rows, "doc_id", "text").collect()}
    assert got == {1}
    assert minhash_dedup.near_duplicates(rows.limit(0), "doc_id", "text").collect() == []


def test_looks_drop_only_unlikely_pairs():
    settings = minhash_dedup.Settings()
    needed = minhash_dedup.least_matches(settings)
    assert needed == sorted(needed) and needed[-1] < 150
    draw = np.random.default_rng(0).random((20_000, 200)) < 0.75
    looks = draw.reshape(20_000, -1, settings.step).sum(axis=2).cumsum(axis=1)
    assert (looks >= np.array(needed)).all(axis=1).mean() > 0.9999


def vectors():
    draw = np.random.default_rng(3)
    base = draw.standard_normal((150, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(60):
        rows.append((1000 + i, (base[i % 7] * 3 + draw.standard_normal(16) * 0.25).tolist()))
    return rows


def test_near_vectors_match_brute_force(make):
    rows = vectors()
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [1.0] * 15 + [None]), (2003, [float("nan")] * 16), (2004, [float("inf")] * 16), (2005, []), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (None, rows[0][1])]
    settings = vector_dedup.Settings(block=16)
    df = make([(*r, 1) for r in rows + odd], "vec_id long, embedding array<float>, n_links int")
    got = {r["vec_id"]: r for r in vector_dedup.near_vectors(df, "vec_id", "embedding", settings).collect()}
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    names = [i for i, _ in rows]
    want = roots(names, [(names[a], names[b]) for a, b in np.argwhere(linked)])
    assert {i: got[i]["n_links"] for i in names} == dict(zip(names, linked.sum(axis=1).tolist(), strict=True))
    assert {i: got[i]["component_id"] for i in names} == want
    for i in range(2000, 2006):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[2006]["n_links"] == got[2007]["n_links"] == 1 and not got[2007]["kept"]
    assert got[None]["n_links"] == 0 and got[None]["kept"]


def test_no_vectors(make):
    df = make([(1, None)], "vec_id long, embedding array<float>")
    assert vector_dedup.near_vectors(df, "vec_id", "embedding").first()["component_id"] == 1
    assert vector_dedup.near_vectors(df.limit(0), "vec_id", "embedding").collect() == []


def test_bound_holds_for_nearly_all_pairs():
    draw = np.random.default_rng(4)
    x = draw.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned, code, factor = vector_dedup.encode(x, vector_dedup.rotations(64, 1, 1))
    centre = vector_dedup.upper_bounds(code, factor, turned, 0.0)
    off = ~np.eye(300, dtype=bool)
    assert abs((centre - x @ x.T)[off].mean()) < 0.005
    assert (vector_dedup.upper_bounds(code, factor, turned, 3.0) >= x @ x.T).mean() > 0.995


def units(text):
    return {" ".join(w) for line in text.split("\n") for ws in [line.split()] for w in [ws[i : i + 16] for i in range(0, len(ws), 16)]}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_match_brute_force(make):
    import hashlib

    random.seed(2)
    texts = [" ".join(random.choices("abcdefghijkl", k=random.choice([0, 1, 30, 400]))) for _ in range(12)]
    texts += ["é\n🙂\n" * 9, "", texts[0], "line\n" * 40 + "end", "\n".join(f"p {i}" for i in range(300)), "\n".join(f"p {i}" for i in range(290)) + "\nq"]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)] + [(400, None)]
    df = make([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(df, "doc_id", "text").collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(likeness(units(text), units(edited)))
        assert row["near_next"] == pytest.approx(likeness(units(text), units(following)))
        assert (row["fingerprint"] == row["edited_fingerprint"]) >= (units(text) == units(edited))
    assert got[rows[0][0]]["fingerprint"] == got[rows[14][0]]["fingerprint"]


def test_fingerprints_of_odd_tables(make):
    schema = "doc_id long, text string"
    assert fingerprints.fingerprint(make([], schema), "doc_id", "text").collect() == []
    only = fingerprints.fingerprint(make([(4, "one\ntwo")], schema), "doc_id", "text").first()
    assert only["near_next"] == 1.0
    rows = fingerprints.fingerprint(make([(None, "a\nb"), (1, "a\nb"), (1, "c")], schema), "doc_id", "text").collect()
    assert sorted(r["doc_id"] is None for r in rows) == [False, False, True]


def test_sketches_subtract_and_peel(make):
    left, right = list(range(0, 60)), list(range(3, 64))
    rows = make([(1, left, right), (2, left, left), (3, list(range(500)), list(range(400, 900)))], "k long, left array<long>, right array<long>")
    got = {r["k"]: (r["only_left"], r["only_right"]) for r in fingerprints.differences(rows, ["k"], "k").collect()}
    assert got == {1: (3, 4), 3: (400, 400)}
    same = fingerprints.sketches(fingerprints.signed(rows.filter("k = 2"), ["k"]), ["k"], "digests", sign="sign")
    assert same.count() == 0
    one = fingerprints.sketches(fingerprints.signed(rows.filter("k = 1"), ["k"]), ["k"], "digests", 16, 3, "sign")
    found = fingerprints.peel(one, ["k"], 3, digests=True).filter("size = 0").collect()
    assert {(r["key"], r["n"]) for r in found} == {(0, 1), (1, 1), (2, 1), (60, -1), (61, -1), (62, -1), (63, -1)}


def test_many_equal_vectors(spark, make):
    from pyspark.sql import functions as F

    one, near, far = [1.0] + [0.0] * 7, [1.0, 0.1] + [0.0] * 6, [0.0] * 7 + [1.0]
    copies = spark.range(20_000).select(F.col("id"), F.lit(one).alias("v"))
    few = make([(30_000, near), (30_001, near), (30_001, near), (30_001, one), (30_002, far), (30_003, far), (30_004, None)], "id long, v array<double>")
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(copies.unionByName(few), "id", "v").collect()}
    assert all(got[i] == (19_999 + 4, 0) for i in range(0, 20_000, 997))
    assert got[30_000] == (20_000 + 3, 0)
    assert got[30_001] == (3 * 20_001, 0)  # three rows of one key, each linked with all rows of other keys
    assert got[30_002] == got[30_003] == (1, 30_002) and got[30_004] == (0, 30_004)
