"""Numbering, ranks and keyword rules, with large keys and edges."""

import re

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.operators import ordering as O
from callsift.operators import rules
from callsift.operators.calls import ID
from callsift.plans import jobs

SAID = f"{ID} string, sntnce string, sntnce_ts long, sntnce_partcpnt_role string"


def talk(conv, lines, start=0):
    """Lines as customer sentences; a line that begins with ``>`` is the agent's."""
    return [
        (conv, t.removeprefix(">"), start + i, "AGENT" if t.startswith(">") else "END_USER")
        for i, t in enumerate(lines)
    ]


def slim(spark, rows):
    said = spark.createDataFrame(rows, SAID)
    return O.number_rows(rules.slim_sentences(said), ID, ["sntnce_ts"])


@pytest.fixture(scope="module")
def skewed(spark):
    """One conversation holds a third of the rows."""
    rows = [("big", i) for i in range(1000)]
    rows += [(f"c{i % 97}", i) for i in range(2000)]
    return spark.createDataFrame(rows, f"{ID} string, ts long").repartition(7)


def test_numbering_agrees_with_and_without_large_keys(skewed):
    plain = O.number_rows(skewed, ID, ["ts"], large_keys=False)
    cut = O.number_rows(skewed, ID, ["ts"], large_keys=True)
    assert sorted(plain.collect()) == sorted(cut.collect())
    assert cut.filter(F.col(ID) == "big").agg(F.max("chunk_id")).first()[0] == 999


def test_equal_times_do_not_depend_on_arrival(spark):
    rows = [("a", i // 5, f"t{i % 5}") for i in range(50)] + [("a", 3, "t1"), (None, 1, None)]
    schema = f"{ID} string, ts long, text string"
    first = sorted(map(str, O.number_rows(spark.createDataFrame(rows, schema), ID, ["ts"]).collect()))
    again = O.number_rows(spark.createDataFrame(rows[::-1], schema).repartition(5), ID, ["ts"], large_keys=True)
    assert sorted(map(str, again.collect())) == first


def test_ranks_keep_rows_without_an_id(spark):
    rows = spark.range(25).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("id"), F.col("id").alias("n"))
    for order in (F.col("id"), O.mixed(F.col("id"))):
        ranked = O.hash_ranks(rows, order, O.MIXED_RANGE, ["id", "n"])
        assert sorted(r["hash_rank"] for r in ranked.collect()) == list(range(1, 26))
    texts = spark.createDataFrame([("x",), ("12",), (None,)], "id string")
    assert texts.select(O.mixed(F.col("id")).alias("h")).filter("h is null").count() == 0


def test_large_key_is_cut_across_partitions(skewed):
    placed = O.global_positions(skewed, [ID, "ts"])
    got = [r["position"] for r in placed.orderBy(ID, "ts").collect()]
    assert got == list(range(3000))


def test_first_rows_limits_before_the_exchange(skewed):
    first = O.first_rows(skewed, ID, ["ts"], 3)
    assert first.groupBy(ID).count().agg(F.max("count")).first()[0] == 3
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hash_ranks_are_dense_per_group(spark):
    rows = spark.range(5000).withColumn("g", (F.col("id") % 10 == 0).cast("int"))
    ranked = O.hash_ranks(rows, O.mixed(F.col("id")), O.MIXED_RANGE, ["id"], by=["g"])
    for g, n in ((0, 4500), (1, 500)):
        got = sorted(r["hash_rank"] for r in ranked.filter(F.col("g") == g).collect())
        assert got == list(range(1, n + 1))
    order = [r["id"] for r in ranked.filter("g = 1").orderBy("hash_rank").collect()]
    assert order == sorted(order, key=lambda i: (i * 2654435761 % 1000003, i))


def test_balanced_classes(spark):
    rows = spark.range(1000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    kept = rules.balanced(rows, "label", O.mixed(F.col("id")), O.MIXED_RANGE, ["id"])
    assert {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()} == {0: 200, 1: 200}


def naive_python(text, role):
    def hit(f):
        return any(re.search(p, text) for p in fv.PATTERNS[f])

    return (
        role == "END_USER"
        and hit("movers")
        and not any(hit(f) for f in ("cancel", "holiday", "expression", "things"))
    )


def test_naive_rule(spark):
    from catalog.views import PHRASES

    rows = talk("a", PHRASES) + talk("b", [">" + p for p in PHRASES])
    found = rules.naive_matches(spark.createDataFrame(rows, SAID)).select(ID, "sntnce_ts")
    want = {(c, ts) for c, t, ts, r in rows if naive_python(t, r)}
    assert set(map(tuple, found.collect())) == want and want


def test_context_looks_three_sentences_later(spark):
    rows = talk("later", ["im moving next month", "a", "b", "please cancel.", "c"])
    rows += talk("earlier", ["please cancel.", "a", "b", "im moving next month", "c"])
    rows += talk("near", ["im moving next month", "please cancel.", "a", "b"])
    numbered = slim(spark, rows)
    selected, removed = rules.preselect(numbered)
    assert {r[0] for r in selected.select(ID).collect()} == {"earlier", "near"}
    assert {r[0] for r in removed.collect()} == {"later"}
    selected, removed = rules.preselect(numbered, mode="both")
    assert {r[0] for r in selected.select(ID).collect()} == {"near"}
    assert {r[0] for r in removed.collect()} == {"later", "earlier"}
    selected, removed = rules.preselect(numbered, mode=None)
    assert selected.count() == 3 and removed.count() == 0
    with pytest.raises(ValueError):
        rules.preselect(numbered, mode="before")


def test_context_stops_at_the_conversation(spark):
    rows = talk("a", ["x", "im moving next month"]) + talk("b", ["x", "please cancel."])
    _, removed = rules.preselect(slim(spark, rows))
    assert removed.count() == 0


def test_cancelled_candidate_removes_even_if_excluded_otherwise(spark):
    rows = talk("a", ["i was moving boxes", "x", "y", "please cancel."])
    rows += talk("a", ["im moving next month"], start=10)
    selected, removed = rules.preselect(slim(spark, rows))
    assert [r[0] for r in removed.collect()] == ["a"]
    assert selected.count() == 1 and rules.without(selected, removed).count() == 0


def test_early_cancellation_counts_all_roles(spark):
    rows = talk("a", ["x"] * 9 + [">please cancel."])
    rows += talk("b", ["x"] * 10 + [">please cancel."])
    said = spark.createDataFrame(rows, SAID)
    assert [r[0] for r in rules.early_cancellations(said).collect()] == ["a"]
    assert [r[0] for r in rules.early_among(slim(spark, rows)).collect()] == ["a"]


def test_first_and_last_clean_line(spark):
    rows = [("a", 0, []), ("a", 1, ["x"]), ("a", 2, ["y", "z"]), ("b", 0, [])]
    lines = spark.createDataFrame(rows, "k string, pos long, tokens array<string>")
    first = {r["k"]: r["tokens"] for r in rules.first_clean_line(lines, "k", "pos", "tokens").collect()}
    assert first == {"a": ["x"], "b": []}
    last = rules.first_clean_line(lines, "k", "pos", "tokens", reverse=True)
    assert {r["k"]: r["tokens"] for r in last.collect()} == {"a": ["y", "z"], "b": []}


def test_threshold_is_exclusive(spark):
    rows = spark.createDataFrame([(0.5,), (0.51,), (0.4,)], "detection_score double")
    assert [r[0] for r in rules.above_threshold(rows).collect()] == [0.51]


def test_no_detection_gives_an_empty_table(spark):
    said = spark.createDataFrame(talk("a", ["hello"]), SAID)
    found = jobs.detect_naive(said)
    assert found.columns == ["conv_id", "detection_score"] and found.count() == 0


def test_sampling_draws_whole_conversations(spark):
    rows = [(str(i % 20), i) for i in range(200)]
    matches = spark.createDataFrame(rows, f"{ID} string, chunk_id long")
    drawn = rules.sample_conversations(matches, 5, O.mixed(F.col(ID)))
    counts = drawn.groupBy(ID).count().collect()
    assert len(counts) == 5 and {r["count"] for r in counts} == {10}
