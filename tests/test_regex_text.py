"""Pattern and text columns against loops over Python's ``re``."""

import random
import re
import string

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions import regex as RX
from callsift.functions.regex import GATES
from callsift.functions import text as TX
from callsift.operators import features as X
from callsift.operators import lexicon as LX
from callsift.operators import token_blocks as TB
from callsift.session import stage

WORDS = (
    "moving move moves house hunting realestate reltor it the is not n't going to was were been did "
    "you me forward around through across time off holiday get rest internet tv plan contract offer "
    "end stop cancel terminate shut finish suspend break yes no okay great thank see [location] "
    "[gender] know école naïve don't it's la und"
).split()
GLUE = [" ", " ", " ", "  ", ".", ",", "\n", " ", "?", "'", ";", "-", "\t"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    out = ["", " ", "moving", "moving me", "cancel", "we aren't moving.", "im not going to move"]
    for _ in range(600):
        out.append("".join(rng.choice(WORDS) + rng.choice(GLUE) for _ in range(rng.randint(1, 9))))
    return out


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def values(frame, column):
    return [r[0] for r in frame.select(column.alias("v"), "i").orderBy("i").select("v").collect()]


PAIRS = [(f, ps) for f, ps in fv.PATTERNS.items()]


@pytest.mark.parametrize("family,patterns", PAIRS)
def test_any_match(frame, texts, family, patterns):
    want = [any(re.findall(p, t) for p in patterns) for t in texts]
    assert values(frame, RX.any_match(F.col("t"), patterns)) == want
    if family in ("movers", "cancel", "things"):
        assert any(want)


def test_any_match_over_all_families(frame, texts):
    flat = [p for ps in fv.PATTERNS.values() for p in ps]
    want = [any(re.search(p, t) for p in flat) for t in texts]
    assert values(frame, RX.any_match(F.col("t"), flat)) == want


def test_gate_words_are_necessary(texts):
    for family, patterns in fv.PATTERNS.items():
        for t in texts:
            if any(re.search(p, t) for p in patterns):
                assert any(w in t for w in GATES[family]), (family, t)


def test_any_match_without_patterns_or_text(make):
    row = make([(None,)], "t string")
    assert row.select(RX.any_match(F.col("t"), fv.PATTERNS["movers"])).first()[0] is False
    assert row.select(RX.any_match(F.col("t"), [])).first()[0] is False


@pytest.mark.parametrize("family,patterns", PAIRS)
def test_all_matches_and_indexes(frame, texts, family, patterns):
    want = [[m for p in patterns for m in re.findall(p, t)] for t in texts]
    assert values(frame, RX.all_matches(F.col("t"), patterns)) == want
    want = [[i for i, p in enumerate(patterns) if re.findall(p, t)] for t in texts]
    assert values(frame, RX.matching_indexes(F.col("t"), patterns)) == want


@pytest.mark.parametrize("family,patterns", PAIRS)
def test_spans(frame, texts, family, patterns):
    want = [[(m.start(), m.group()) for p in patterns for m in re.finditer(p, t)] for t in texts]
    got = [[tuple(s) for s in v] for v in values(frame, RX.all_spans(F.col("t"), patterns))]
    assert got == want


def test_start_totals(frame, texts):
    patterns = fv.PATTERNS["movers"]
    starts = [[m.start() for p in patterns for m in re.finditer(p, t)] for t in texts]
    got = [tuple(v) for v in values(frame, RX.start_totals(F.col("t"), patterns))]
    assert got == [(len(s), sum(s)) for s in starts]


def test_keywords(frame, texts):
    words = ["moving", "la", "it", "plan"]
    boundary = [rf"((?:\s|^){w}(?:\s|\.|\,|\!|\?|$|(?:'s)))" for w in words]
    want = [sorted({m.strip() for p in boundary for m in re.findall(p, t)}) for t in texts]
    assert values(frame, RX.keyword_matches(F.col("t"), words)) == want
    want = [[(m.start(), m.group()) for p in boundary for m in re.finditer(p, t)] for t in texts]
    assert [[tuple(s) for s in v] for v in values(frame, RX.keyword_spans(F.col("t"), words))] == want


def test_move_to_is_not_a_mover_and_negation_is_literal(make):
    rows = make(
        [("we move to ottawa",), ("i am not moving",), ("we aren't moving ",), ("not  going to move ",)],
        "t string",
    )
    got = rows.select(
        RX.any_match(F.col("t"), fv.PATTERNS["movers"]), RX.any_match(F.col("t"), fv.PATTERNS["negation"])
    ).collect()
    assert got[0][0] is False
    assert [r[1] for r in got[:3]] == [False, False, True]


def test_remove_tokens(frame, texts):
    tokens = [*fv.TAGS, *fv.FILLER_WORDS]
    want = [re.sub(f"({'|'.join(tokens)})", "", t.lower()).strip() for t in texts]
    assert values(frame, X.cleaned(F.col("t"))) == want


def test_remove_tokens_works_inside_words_unless_told(make):
    row = make([("i know the house is great, yes [location] thank you",)], "t string")
    assert row.select(X.cleaned(F.col("t"))).first()[0] == "i kw the use is ,"
    whole = row.select(TX.remove_tokens(F.col("t"), fv.FILLER_WORDS, whole_word=True)).first()[0]
    assert whole == "i know the house is ,  [location]"


def python_clean(text, stop, tags):
    if not text:
        return []
    if tags is not None:
        text = re.sub(f"({'|'.join(tags)})", "", text).strip().lower()
    text = re.sub(r"(\-|\_|\.|\/|\\|\:|\;|\,|\n|\[|\])", " ", text).strip()
    return [t for t in re.findall(r"(?i)((?:[a-z]|')+)", text) if t not in stop and len(t) > 1]


def test_clean_tokens(frame, texts):
    stop = ["the", "it", "is"]
    assert values(frame, TX.clean_tokens(F.col("t"), stop, fv.TAGS)) == [
        python_clean(t, stop, fv.TAGS) for t in texts
    ]
    assert values(frame, TX.clean_tokens(F.col("t"))) == [python_clean(t, [], None) for t in texts]


def test_clean_tokens_keeps_case_without_tags_and_handles_null(make):
    rows = make([(1, "Hello A World"), (2, None)], "i int, t string")
    assert values(rows, TX.clean_tokens(F.col("t"))) == [["Hello", "World"], []]


def test_training_tokens(frame, texts):
    def python(text):
        text = re.sub(f"({'|'.join(fv.TAGS)})", "", text).strip().lower()
        text = re.sub(r"[^\w\s]", "", text.lower().strip())
        return [w for w in text.split() if w not in ("the", "is")]

    assert values(frame, TX.training_tokens(F.col("t"), ["the", "is"], fv.TAGS)) == [python(t) for t in texts]


def test_sub_sentences(frame, texts):
    want = [[s for s in re.split(r"(?:\.|\;|\,)", t) if len(s) > 5] for t in texts]
    assert values(frame, TX.sub_sentences(F.col("t"))) == want


def test_word_grams(frame, texts):
    want = [t.split() for t in texts]
    assert values(frame, TX.word_grams(F.col("t"))) == want
    want = [[" ".join(w[i : i + 3]) for i in range(len(w))] for w in want]
    assert values(frame, TX.word_grams(F.col("t"), 3)) == want


def test_normalise_and_marks(make):
    row = make([("It's [ok], \x1b[1mMoving\x1b[0m!",)], "t string")
    plain = row.select(TX.without_ansi_marks(F.col("t"))).first()[0]
    assert plain == "It's [ok], Moving!"
    drop = str.maketrans("", "", string.punctuation)
    assert row.select(TX.normalise(F.lit(plain))).first()[0] == plain.lower().translate(drop)


def test_relative_position(frame, texts):
    def python(text):
        starts = [m.start() for p in fv.PATTERNS["movers"] for m in re.finditer(p, text)]
        return sum(starts) / (len(text) * len(starts)) if starts else -1

    assert values(frame, X.relative_position(F.col("t"))) == pytest.approx([python(t) for t in texts])


def test_erased_match_gives_minus_one(make):
    row = make([("we went house hunting",)], "t string")
    assert row.select(X.relative_position(X.cleaned(F.col("t")))).first()[0] == -1.0


def test_both_dictionary_plans_agree(spark, make):
    forms = {f"w{i}": f"l{i % 7}" for i in range(300)}
    rows = make(
        [(i, [f"w{(i * 7 + k) % 400}" for k in range(i % 12)]) for i in range(50)],
        "id int, tokens array<string>",
    )
    table = make(sorted(forms.items()), "form string, lemma string")
    narrow = rows.select("id", LX.replace_words(F.col("tokens"), forms).alias("tokens"))
    joined = LX.replace_words_by_join(rows, "id", "tokens", table)
    assert sorted(map(tuple, narrow.collect()), key=str) == sorted(
        map(tuple, joined.select("id", "tokens").collect()), key=str
    )
    first = narrow.filter("id = 5").first()["tokens"]
    assert first == [forms.get(f"w{(35 + k) % 400}", f"w{(35 + k) % 400}") for k in range(5)]


LONG = [f"w{i % 977}" for i in range(40_000)]


def lists(make, rows):
    return make([(i, t, "x") for i, t in rows], "id long, tokens array<string>, found string")


def test_words_of_long_rows_are_joined_in_linear_time(spark, make):
    import time

    rows = lists(make, [(1, LONG), (2, ["w1", None, "w2", "other"]), (3, []), (4, None), (None, ["w3", "w3", "z"])])
    forms = make([(f"w{i}", f"l{i}") for i in range(500)] + [("w1", "zz"), ("unused", "u"), (None, "n"), ("z", None)], "form string, lemma string")
    change = lambda ts: ts and [f"l{t[1:]}" if t and t != "z" and t[0] == "w" and int(t[1:]) < 500 else t for t in ts]
    LX.replace_words_by_join(rows, "id", "tokens", forms).collect()
    start = time.time()
    got = {r["id"]: r["tokens"] for r in LX.replace_words_by_join(rows, "id", "tokens", forms).collect()}
    assert time.time() - start < 8
    assert got == {1: change(LONG), 2: ["l1", None, "l2", "other"], 3: [], 4: None, None: ["l3", "l3", "z"]}
    gone = make([(f"w{i}",) for i in range(500)] + [(None,), ("w1",)], "word string")
    start = time.time()
    got = {r["id"]: r["tokens"] for r in LX.drop_words_by_join(rows, "id", "tokens", gone).collect()}
    assert time.time() - start < 8
    assert got == {1: [t for t in LONG if int(t[1:]) >= 500], 2: [None, "other"], 3: [], 4: None, None: ["z"]}


def test_padded_ids_of_a_row_without_key(make):
    rows = make([(None, ["a", "b", "?"]), (1, ["b"]), (2, [])], "id long, tokens array<string>")
    vocab = make([("a", 2), ("b", 3)], "token string, id long")
    got = {r["id"]: r["ids"] for r in LX.padded_ids(rows, "id", "tokens", vocab, 4).collect()}
    assert got == {None: [2, 3, 1, 0], 1: [3, 0, 0, 0], 2: [0, 0, 0, 0]}


def test_vocabulary_order(make):
    rows = [(3, ["b", "a", "b"]), (None, ["c", "d"]), (1, ["z", "a", "y"]), (1, ["q"])]
    for kind, key in (("long", lambda k: k), ("string", lambda k: k if k is None else str(k))):
        table = make([(key(k), t) for k, t in rows], f"id {kind}, tokens array<string>")
        got = [(r["token"], r["count"]) for r in LX.vocabulary(table, "id", "tokens").orderBy("id").collect()]
        assert got[:4] == [("a", 2), ("b", 2), ("c", 1), ("d", 1)] and sorted(got[4:]) == [("q", 1), ("y", 1), ("z", 1)]
    assert LX.vocabulary(make([], "id long, tokens array<string>"), "id", "tokens").collect() == []


def merged_plain(tokens, pairs):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
            out.append(f"{tokens[i]} {tokens[i + 1]}")
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def test_pairs_merge_as_a_loop_does(make):
    random.seed(2)
    pairs = [("a", "a"), ("a", "b"), ("b", "c"), ("c", "a")]
    rows = [(i, random.choices("abcd", k=random.randint(0, 14))) for i in range(60)] + [(None, ["a", "a", "a"]), (99, ["a"] * 3001)]
    table = make([(i, t, 1) for i, t in rows] + [(100, None, 1)], "id long, tokens array<string>, n int")
    got = {r["id"]: r["tokens"] for r in LX.merge_pairs(table, "id", "tokens", make(pairs, "a string, b string")).collect()}
    assert got == {**{i: merged_plain(t, set(pairs)) for i, t in rows}, 100: []}
    assert LX.merge_pairs(table, "id", "tokens", make(pairs, "a string, b string")).columns == ["id", "n", "tokens"]


def test_spans_of_texts_that_hold_the_marks(make):
    texts = ["ab ab ab", "ab", "ab ab", "", "x", None, "aab"]
    table = make([(t,) for t in texts], "t string")
    for pattern in ("a+b", "(a)|b", r"(?<=a)b", r"\bab\b"):
        got = [r[0] for r in table.select(RX.match_spans(F.col("t"), pattern)).collect()]
        assert [[tuple(s) for s in g] for g in got] == [[(m.start(), m.group()) for m in re.finditer(pattern, t or "")] for t in texts]


def test_alternations_by_first_character_match_alike(make):
    tokens = ["yes", "ya", "yeah", "no", r"\[x\]", "y", "9"]
    assert TX._by_first(tokens).startswith("(?=[")
    for texts in ("yeah yaya no[x]9", "yyes", "[x", "noyeahs"):
        assert re.sub(TX._by_first(tokens), "_", texts) == re.sub("|".join(tokens), "_", texts)
    assert TX._by_first(["a|b", "c"]) == "(?:a|b|c)" and TX._by_first([".x", "c"]) == "(?:.x|c)"


def test_rare_pairs_are_not_staged(spark, monkeypatch):
    """Of pairs under the least count only their number goes on; scores are as counted by hand."""
    rows = spark.createDataFrame(
        [(["a", "b", "a", "b", "c"],), (["a", "b"],), (["d"],), ([],), (None,), (["a", "b", "a", "b"],), (["a", "a", "a"],)],
        "tokens array<string>",
    )
    staged = []

    def kept(df):
        staged.append(stage(df))
        return staged[-1]

    monkeypatch.setattr(LX, "stage", kept)
    got = [(r["a"], r["b"], r["n_ab"], r["score"]) for r in LX.pair_scores(rows, "tokens", min_count=3, threshold=0.5).collect()]
    # words: a 8, b 5, c 1, d 1; pairs: ab 5, ba 2, bc 1, aa 2
    assert got == [] and LX.pair_scores(rows, "tokens", 3, 0.3).first()["score"] == (5 - 3) * 8 / (8 * 5)
    assert sorted((r["a"], r["b"], r["n"]) for r in staged[0].filter("pair").collect()) == [("a", "b", 5)]
    assert LX.pair_scores(rows.limit(0), "tokens").collect() == []


def test_words_of_a_block_are_looked_up_once(make):
    """Rows of one key keep their own tokens, and a frequent word leaves a task once for a block."""
    rows = [(1, ["a", "a", "b", None]), (1, ["b", "c"]), (None, ["a"]), (2, None), (3, []), (4, ["d"] * 50), (5, ["é", "a"])]
    table = make(rows, "id long, tokens array<string>").coalesce(1)
    forms = make([("a", "x"), ("d", "y"), ("d", "z"), ("b", None), (None, "n")], "form string, lemma string")
    to = {"a": "x", "d": "y"}
    got = [(r["id"], r["tokens"]) for r in LX.replace_words_by_join(table, "id", "tokens", forms).collect()]
    want = [(k, t and [to.get(w, w) for w in t]) for k, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    gone = make([("a",), ("a",), ("d",), (None,)], "word string")
    got = [(r["id"], r["tokens"]) for r in LX.drop_words_by_join(table, "id", "tokens", gone).collect()]
    want = [(k, t and [w for w in t if w not in ("a", "d")]) for k, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    blocks = table.select(F.lit(0).cast("long").alias("_block"), F.col("tokens").alias("_tokens"))
    assert blocks.mapInArrow(TB._words_of_blocks, "_block long, _word string").count() == 6
    assert {r[0] for r in TB.distinct_words(table, "tokens").collect()} == {"a", "b", "c", "d", "é", None}


def test_vocabulary_counts_a_block_before_the_exchange(make):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3, 7]), rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(80)] + [(4, None), (5, ["z", "y"])]
    table = make(rows, "id long, tokens array<string>")
    assert TB.first_places(table.coalesce(1), F.col("id"), "tokens").count() == 8 + 10  # null keys apart
    seen = {}
    for key, words in rows:
        for pos, word in enumerate(words or []):
            seen.setdefault(word, []).append((key, pos))

    def order(word):
        none = [p for k, p in seen[word] if k is None]
        first = min((k, p) for k, p in seen[word] if k is not None)
        return -len(seen[word]), not none, min(none, default=0), first

    want = [(w, len(seen[w]), i + 2) for i, w in enumerate(sorted(seen, key=order))]
    got = LX.vocabulary(table.repartition(3), "id", "tokens").orderBy("id").collect()
    assert [(r["token"], r["count"], r["id"]) for r in got] == want


def test_blocks_end_between_rows(monkeypatch, make):
    rows = [(i, ["a", "b", str(i % 3)] * (i % 4)) for i in range(40)]
    table = make(rows, "id long, tokens array<string>").coalesce(1)
    whole = LX.vocabulary(table, "id", "tokens").collect()
    held = pa.RecordBatch.from_pylist([{"_tokens": t} for _, t in rows], pa.schema([("_tokens", pa.list_(pa.string()))]))
    monkeypatch.setattr(TB, "MOST_TOKENS", 10)
    parts = list(TB._pieces(held, "_tokens"))
    assert [r["_tokens"] for p in parts for r in p.to_pylist()] == [t for _, t in rows]
    assert len(parts) > 10 and all(len(p) == 1 or pc.sum(pc.list_value_length(p["_tokens"])).as_py() <= 10 for p in parts)
    assert len(whole) == 5


def test_corpus_tokens_split_as_a_loop_does(make):
    texts = ["", " ", None, "a  b.c", "x" + fv.TOKENIZER_FILTERS + "y z\r\x0bé w😀", "-a-", "\\[]^&&a", "İI\x00"]
    split = lambda t: [w for w in "".join(" " if c in fv.TOKENIZER_FILTERS else c for c in t.lower()).split(" ") if w]
    got = [r[0] for r in make([(t,) for t in texts], "t string").select(TX.corpus_tokens(F.col("t"))).collect()]
    assert got == [split(t or "") for t in texts]
