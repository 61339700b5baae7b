import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from callsift.llm import byte_bpe, source_mix
from callsift.llm.queries import tokenizer

tiktoken = pytest.importorskip("tiktoken")

TEXTS = [None, "", " ", "Hello world", "  two  spaces \n\n\t x", "naïve 中文字 🙂🙂 ﬁn", "I'll we've don't 12345 ---- !!!", "a" * 300, "́​﻿", "é" * 50]


@pytest.fixture(scope="module")
def reference():
    path, pattern = tokenizer()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_reference_library(spark, make, reference):
    rows = make([(i, t, "old") for i, t in enumerate(TEXTS)], "id long, text string, ids string")
    got = {r["id"]: r for r in byte_bpe.encode_and_decode(rows, "text", *tokenizer()).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i]["ids"] == reference.encode_ordinary(text or "")
        assert bytes(got[i]["decoded"]) == (text or "").encode()


def test_random_texts(reference):
    random.seed(5)
    parts = ["a", "aa", " ", "  ", "-", "\n", "é", "7", "'s", "中", "🙂", "the", "tion", " ", "​", ".", "A"]
    for _ in range(3000):
        text = "".join(random.choice(parts) * random.choice([1, 1, 2, 5, 9]) for _ in range(random.randint(1, 12)))
        assert next(byte_bpe.encode_texts([text], *tokenizer()))[0] == reference.encode_ordinary(text)


def test_long_texts_are_cut_where_nothing_changes(reference):
    random.seed(6)
    text = "".join(random.choice(["word", " ", "\n", "  x", "12", "!", "é"]) for _ in range(60_000))
    assert "".join(byte_bpe.pieces(text, 1000)) == text
    assert len(byte_bpe.pieces(text, 1000)) > 50
    assert next(byte_bpe.encode_texts([text], *tokenizer()))[0] == reference.encode_ordinary(text)


def test_spans_cover_the_text(make):
    text = "naïve 中文 🙂 end"
    row = byte_bpe.encode(make([(text,)], "text string"), "text", *tokenizer(), spans=True).first()
    spelled = [text[a:b] for a, b in zip(row["starts"], row["ends"], strict=True)]
    covered = sorted({i for a, b in zip(row["starts"], row["ends"], strict=True) for i in range(a, b)})
    assert covered == list(range(len(text)))
    assert spelled[-1].strip() in "end"


def test_decoding_in_parts(make):
    path, pattern = tokenizer()
    ids = next(byte_bpe.encode_texts(["🙂 中 ﬁ"], path, pattern))[0]
    decoder = byte_bpe.TextDecoder(path, pattern)
    parts = [decoder.feed([i]) for i in ids] + [decoder.feed([], True)]
    assert "".join(parts) == "🙂 中 ﬁ"
    rows = make([(ids,), (None,), ([],)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode(rows, "ids", path, pattern).collect()] == ["🙂 中 ﬁ".encode(), b"", b""]


def test_digest_and_empty_table(make):
    row = make([([5, 17],), ([],)], "ids array<int>").select(byte_bpe.ids_digest(F.col("ids")).alias("d")).collect()
    assert [r["d"] for r in row] == [hashlib.sha256(b"5,17").hexdigest(), hashlib.sha256(b"").hexdigest()]
    assert byte_bpe.encode(make([], "text string"), "text", *tokenizer()).collect() == []


def fill(sizes, weights, most=3.0):
    """Water-filling by rounds: clamp what is above, share the rest anew."""
    targets, clamped, total = [0.0] * len(sizes), set(), float(sum(sizes))
    while True:
        left = total - sum(most * sizes[i] for i in clamped)
        weight = sum(w for i, w in enumerate(weights) if i not in clamped)
        for i, w in enumerate(weights):
            targets[i] = most * sizes[i] if i in clamped else left * w / weight if weight else 0.0
        over = {i for i in range(len(sizes)) if i not in clamped and targets[i] > most * sizes[i]}
        if not over:
            return targets
        clamped |= over


def test_water_filling_matches_rounds(make):
    random.seed(2)
    for _ in range(5):
        sizes = [random.choice([0, 1, 5, 50, 1000, 10000]) for _ in range(random.randint(1, 9))]
        weights = [float(random.choice([1, 2, 3])) for _ in sizes]
        rows = make(list(zip(range(len(sizes)), sizes, weights, strict=True)), "i int, source_size long, weight double")
        got = {r["i"]: r["target"] for r in source_mix.water_fill(rows).collect()}
        for i, want in enumerate(fill(sizes, weights)):
            assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-6)


def test_mix(make):
    random.seed(1)
    rows = [(i, random.choice(["a", "b", None, "é", "z"] + ["hot"] * 4), " ".join(["w"] * random.randint(0, 40)), i) for i in range(3000)]
    rows += [(5000, "a", None, 1), (None, "a", "one two", 1), (None, None, "", 1)] + [(6000, "b", "same row", 1)] * 3
    df = make(rows, "doc_id long, source string, text string, size long")
    mixed = source_mix.mix(df, "doc_id", "source", source_mix.word_count(F.col("text")), carry=["size"])
    got = mixed.collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixed.collect()))
    sources = sorted({r[1] for r in rows if r[1] is not None}) + [None]
    sizes = [sum(len((t or "").split()) for _, s, t, _ in rows if s == source) for source in sources]
    for source, want, size in zip(sources, fill(sizes, [float(i % 3 + 1) for i in range(len(sources))]), sizes, strict=True):
        mine = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == size and r["target"] == pytest.approx(want) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want) <= 40
        assert all(r["taken"] == r["size"] * r["repeats"] and r["repeats"] <= 3 for r in mine)


def test_mix_of_nothing(make):
    df = make([], "doc_id long, source string, text string")
    assert source_mix.mix(df, "doc_id", "source", source_mix.word_count(F.col("text"))).collect() == []
    df = make([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    got = source_mix.mix(df, "doc_id", "source", source_mix.word_count(F.col("text"))).collect()
    assert [r["taken"] for r in got] == [0, 0] and [r["target"] for r in got] == [0.0, 0.0]
