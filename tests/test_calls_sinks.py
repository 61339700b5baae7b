"""Extraction from nested calls, and tables that results go to."""

import datetime

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift import schemas
from callsift.operators import calls as C
from callsift.operators import reports as R
from callsift.operators import rules
from callsift.plans import jobs
from callsift.sources import readers, sinks

DAY = datetime.date(2022, 4, 11)
ID = C.ID


def sentence(text, ts, role="END_USER", lang="en-US", score=0.5, magnitude=2.0):
    return (text, ts, lang, role, score, magnitude)


def call(name, labels=(), issues=(), said=(), day=DAY, src=7):
    return (name, day, src, list(labels), [(i,) for i in issues], list(said))


TWO_PARTY = [
    sentence("Hello", 1),
    sentence("im moving next month", 2),
    sentence("Hi", 3, "AGENT"),
    sentence("Yes", 4, "AGENT"),
]


@pytest.fixture(scope="module")
def calls(spark):
    rows = [
        call("ok", [("ANI", "4165550000"), ("VQ", "q2"), ("VQ", "q1"), ("VQ", "q2"), ("BAN", "12")], ["b", "a", "b"], TWO_PARTY),
        call("ok", [("callback_tn", "2505550000")], ["c"], []),
        call("no labels", [], ["a"], TWO_PARTY),
        call("no issue", [("ANI", "416")], [], TWO_PARTY),
        call("unknown", [("ban", "0000000000"), ("ANI", ""), ("RTargetAgentSelected", "x")], ["a"], TWO_PARTY),
        call("one party", [("ANI", "416")], ["a"], [sentence("moving", i) for i in range(4)]),
        call("two codes", [("ANI", "416")], ["a"], TWO_PARTY + [sentence("Bye", 5, lang="en-us")]),
        call("french", [("ANI", "416")], ["a"], [(s[0], s[1], "fr-CA", *s[3:]) for s in TWO_PARTY]),
        call("short", [("ANI", "416")], ["a"], TWO_PARTY[1:]),
        call("holes", [("ANI", "416")], ["a"], [sentence("", 1), sentence("\n", 2), sentence(None, 3), sentence("x", 4, None), sentence("y", 5, lang=None)] + TWO_PARTY),
        call("other day", [("ANI", "416")], ["a"], TWO_PARTY, datetime.date(2022, 4, 12)),
    ]
    return spark.createDataFrame(rows, schemas.CALLS)


def ids(df, column=ID):
    return sorted({r[0] for r in df.select(column).collect()})


def test_conversations(calls):
    found = C.conversations(calls)
    assert ids(found) == ["french", "holes", "ok", "one party", "other day", "short", "two codes"]
    twice = found.filter(F.col(ID) == "ok").collect()
    assert len(twice) == 2
    row = twice[0]
    assert row["virtualqueues"] == "q1,q2" and row["bus_bacct_num"] == "12"
    assert row["telephone"] == "2505550000,4165550000" and row["topics"] == "a,b,c"
    assert row["agnt_id"] is None


def test_one_pass_attributes_equal_the_separate_ones(calls):
    whole = C.call_attributes(calls)
    parts = C.label_attributes(calls).join(C.topics(calls), ID).select(*whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_sentences_of_one_time_keep_their_spoken_order(spark):
    texts = ["hello", "i am moving", "", "so", "well", "ok", "please cancel", "bye", "thanks"]
    said = [sentence(t, 7, "AGENT" if i % 2 else "END_USER") for i, t in enumerate(texts)]
    rows = spark.createDataFrame([call("c", [("ANI", "4165550000")], ["a"], said)], schemas.CALLS)
    _, found = jobs.extract(rows, "2022-04-11", "2022-04-11", places=True)
    for large in (False, True):
        kept = rules.number_kept(found, F.lit(True), large_keys=large).orderBy("chunk_id").collect()
        assert [r["sntnce"] for r in kept] == [t for t in texts if t]
    slim = rules.slim_sentences(found)
    assert C.PLACE in slim.columns
    _, plain = jobs.extract(rows, "2022-04-11", "2022-04-11")
    assert C.PLACE not in plain.columns


def test_eligible_sentences(calls):
    said = C.sentences(calls)
    found = C.eligible_sentences(said, C.eligible_ids(said, 2, "en-us"))
    assert ids(found) == ["holes", "no issue", "no labels", "ok", "other day", "unknown"]
    assert found.filter(F.col(ID) == "holes").count() == 4
    assert {r[0] for r in found.select("sntnce_sntmnt").collect()} == {1.0}
    both = C.two_party(said, 2).join(C.single_language(said, "en-us"), ID)
    assert ids(both) == ids(found)


def test_extraction_keeps_what_has_both_sides(calls):
    convs, said = jobs.extract(calls, "2022-04-11", "2022-04-11")
    assert ids(convs) == ids(said) == ["holes", "ok"]
    assert convs.count() == 3
    a, b = C.with_both(convs, said)
    assert a.count() == convs.count() and b.count() == said.count()
    assert [r[0] for r in convs.select("pr_name").distinct().orderBy("pr_name").collect()] == ["BC", "ON"]


def test_daily_job_equals_its_parts(calls):
    day = F.lit("2022-05-01").cast("date")
    whole = jobs.naive_daily(calls, "2022-04-11", "2022-04-12", refresh_date=day)
    convs, said = jobs.extract(calls, "2022-04-11", "2022-04-12")
    parts = sinks.detection_rows(jobs.with_facts(jobs.detect_naive(said), convs), day)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert ids(whole, "convrstn_id") == ["holes", "ok", "other day"]


def test_default_window(spark):
    lo, hi = C.default_window()
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi"), F.current_date().alias("now")).first()
    assert row["lo"] == row["hi"] == row["now"] - datetime.timedelta(days=1)
    lo, hi = C.default_window("2022-04-01", "2022-04-30")
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (row["lo"].day, row["hi"].day) == (1, 30)


def test_province(make):
    rows = make([("4165550000",), ("999",), (None,), ("",)], "n string")
    assert [r[0] for r in rows.select(C.province(F.col("n"))).collect()] == ["ON", None, None, None]


def test_detection_rows(make):
    schema = "conv_id string, call_convrstn_date date, bus_bacct_num string, bus_bacct_num_src_id long, telephone string, detection_score double"
    rows = make([("a", DAY, "", 0, "t", 0.8125), ("b", None, "0", 5, None, 1.0)], schema)
    got = sinks.detection_rows(rows, F.lit(DAY)).collect()
    assert tuple(got[0]) == ("a", DAY, DAY, None, None, "t", "moves", 0.812)
    assert tuple(got[1]) == ("b", None, DAY, "0", 5, None, "moves", 1.0)


def test_upsert(spark, make, tmp_path):
    schema = "call_convrstn_id string, chunk_id long, text string"
    first = make([("a", 1, "x"), ("a", 2, "y")], schema)
    second = make([("a", 2, "z"), ("b", 1, "w")], schema)
    for rows in (first, second, second, make([], schema)):
        sinks.load_examples(spark, "examples_t", rows)
    got = sorted(map(tuple, sinks.stored(spark, "examples_t").collect()))
    assert got == [("a", 1, "x"), ("a", 2, "z"), ("b", 1, "w")]
    with pytest.raises(ValueError):
        sinks.load_examples(spark, "examples_t", make([("a", 1, "p"), ("a", 1, "q")], schema))
    with pytest.raises(Exception, match="longer than 30"):
        sinks.load_examples(spark, "examples_t", make([("a" * 31, 1, "p")], schema))
    with pytest.raises(Exception, match="is null"):
        sinks.load_examples(spark, "examples_t", make([(None, 1, "p")], schema))
    assert readers.read_table(spark, "examples_t").count() == 3
    spark.sql("DROP TABLE examples_t")


def test_upsert_leaves_other_buckets_alone(spark, make, tmp_path):
    import os

    schema, place = "call_convrstn_id string, chunk_id long, text string", str(tmp_path / "table")
    sinks.load_examples(spark, "buckets_t", make([(f"c{i}", 1, "x") for i in range(500)], schema), place)
    seen = lambda: {os.path.join(d, f) for d, _, fs in os.walk(place) for f in fs if f.startswith("part-")}
    before = seen()
    sinks.load_examples(spark, "buckets_t", make([("c7", 1, "y")], schema), place)
    after = seen()
    assert len({os.path.dirname(f) for f in before ^ after}) == 1 and len(before & after) > 40
    assert sinks.stored(spark, "buckets_t").groupBy("text").count().collect() and sinks.stored(spark, "buckets_t").count() == 500
    assert sinks.stored(spark, "buckets_t").filter("text = 'y'").count() == 1
    ddl = spark.sql("SHOW CREATE TABLE buckets_t").first()[0]
    assert "one row for each conversation and position" in ddl
    spark.sql("DROP TABLE buckets_t")


def test_new_keys_are_added_and_files_stay(spark, make, tmp_path):
    import os

    schema, place = "call_convrstn_id string, chunk_id long, text string", str(tmp_path / "table")
    sinks.load_examples(spark, "added_t", make([(f"c{i}", 1, "x") for i in range(3000)], schema), place)
    seen = lambda: {os.path.join(d, f) for d, _, fs in os.walk(place) for f in fs if f.startswith("part-")}
    before = seen()
    sinks.load_examples(spark, "added_t", make([(f"d{i}", 1, "x") for i in range(30)], schema), place)
    assert before <= seen() and sinks.stored(spark, "added_t").count() == 3030
    # one key in a hundred, most of them new
    before = seen()
    sinks.load_examples(spark, "added_t", make([(f"e{i}", 1, "y") for i in range(28)] + [("c5", 1, "y"), ("c6", 1, "y")], schema), place)
    assert len(before - seen()) <= 2 * 64 / 10 and sinks.stored(spark, "added_t").count() == 3058
    assert sinks.stored(spark, "added_t").filter("text = 'y'").count() == 30
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    spark.sql("DROP TABLE added_t")


def test_buckets_are_split_as_a_table_grows(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKETS", 2)
    monkeypatch.setattr(sinks, "ROWS_OF_BUCKET", 10)
    schema = "call_convrstn_id string, chunk_id long, text string"
    place = str(tmp_path / "table")
    want = {}
    for start, n, buckets in ((0, 15, 2), (10, 20, 4), (0, 5, 4), (100, 100, 16), (90, 12, 16)):
        rows = [(f"c{i}", 1, f"t{start}") for i in range(start, start + n)]
        want.update({r[0]: r[2] for r in rows})
        sinks.load_examples(spark, "grown_t", make(rows, schema), place)
        assert sinks.bucket_count(spark, "grown_t") == buckets
        got = sinks.stored(spark, "grown_t").collect()
        assert {r[0]: r[2] for r in got} == want and len(got) == len(want)
    held = spark.table("grown_t").select(sinks.BUCKET, sinks.key_bucket(["call_convrstn_id", "chunk_id"], 16).alias("b"))
    assert held.filter(f"{sinks.BUCKET} <> b").count() == 0
    spark.sql("DROP TABLE grown_t")


def test_loading_leaves_nothing_staged(spark, calls, tmp_path):
    from callsift.session import stage, staged

    kept = stage(spark.range(3))
    before = staged(spark)
    place = str(tmp_path / "table")
    jobs.load_naive_daily(spark, calls, "2022-04-11", "2022-04-11", "left_t", place)
    assert staged(spark) == before and kept.count() == 3
    assert ids(sinks.stored(spark, "left_t"), "convrstn_id") == ["holes", "ok"]
    spark.sql("DROP TABLE left_t")


def test_one_row_for_each_conversation(make):
    schema = "convrstn_id string, call_date date, src_id long, ban string, telephone string"
    late = datetime.date(2022, 4, 12)
    rows = [("a", DAY, 1, "1", "x"), ("a", late, 3, "1", "x"), ("a", late, 2, "9", "long" * 20), ("a", late, None, "0", "x"), ("b", None, None, None, None)]
    got = {r[0]: tuple(r) for r in sinks.one_per_conversation(make(rows, schema)).collect()}
    assert got == {"a": ("a", late, 2, "9", "long" * 20), "b": ("b", None, None, None, None)}


def test_an_empty_issue_name_is_a_name(make):
    calls = make([("a", [("",)]), ("b", [("x",), ("",)]), ("c", [(None,)])], f"{ID} string, convrstn_iss array<struct<iss_nm: string>>")
    assert {r[0]: r[1] for r in C.topics(calls).collect()} == {"a": "", "b": ",x", "c": None}


def test_statement_needs_a_text(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.run_sql(spark)
    path = tmp_path / "q.sql"
    path.write_text("SELECT :a + 1 AS b")
    assert readers.run_sql(spark, path=str(path), args={"a": 2}).first()["b"] == 3


def test_json_document(spark, tmp_path):
    assert readers.read_json(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        readers.read_json(spark, str(tmp_path / "none"), must_exist=True)
    (tmp_path / "d.json").write_text('{"a":\n 1}')
    assert readers.read_json(spark, str(tmp_path / "d.json")).first()["a"] == 1


def test_packs_and_words(spark, tmp_path):
    path = tmp_path / "words"
    path.write_text("a\nthe\n")
    assert readers.stopword_list(spark, str(path), ["the", "no"]) == ["a", "no", "the"]
    table = readers.pack_table(spark).groupBy("family").count().collect()
    assert {r[0]: r[1] for r in table} == {
        "movers": 5, "cancel": 13, "holiday": 3, "expression": 4, "things": 5, "negation": 1, "past": 1,
    }
    assert (len(fv.FILLER_WORDS), len(fv.TAGS), len(fv.MOVE_SENTENCES), len(fv.AREA_CODES)) == (20, 7, 26, 41)
    pack = tmp_path / "pack.yaml"
    pack.write_text("regex_movers:\n - '\\smove'\nto_remove:\n - 'no'\ntags: []\n")
    assert readers.read_pack(str(pack)) == ({"movers": ["\\smove"]}, ["no"], [])


def test_geo_pack(make):
    countries = make([("Canada / CA", "Canadian", None), ("canada", "", "French/English")], "country string, nationality string, language string")
    regions = make([("Quebec", "Quebecers"), ("Quebec", "Quebecois")], "name string, population string")
    got = {}
    for r in readers.geo_pack(countries, regions).collect():
        got.setdefault(r["family"], []).append(r["pattern"])
    assert {k: len(v) for k, v in got.items()} == {
        "country": 2, "nationality": 1, "language": 2, "region": 2, "region_people": 2,
    }
    assert r"(?:(?:\s|^|\.|\,)(canada)(?:\s|$|\.|\,|\?|\!|\;))" in got["country"]


def test_sizing_and_description(make):
    convs = make(
        [("a", "ON", 0.8, "1"), ("b", "ON", 0.75, "1"), ("c", None, 0.9, None), ("d", "QC", None, "1"), ("e", "ON", 0.9, None)],
        f"{ID} string, pr_name string, iss_max double, num string",
    )
    said = make([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z"), ("e", "z")], f"{ID} string, sntnce string")
    got = {r[0]: tuple(r)[1:] for r in R.sizing(convs, said).collect()}
    assert got == {"ON": (3, 3, 2, 1), "QC": (1, 0, 0, 0), "ALL": (5, 4, 3, 1)}
    row = R.describe(R.sentence_counts(said), "sntnce").first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["p75"], row["max"]) == (4, 1.25, 0.5, 1, 1.25, 2)


def test_daily_plan_reads_and_moves_little(spark, calls, tmp_path):
    path = str(tmp_path / "calls")
    calls.write.partitionBy(C.DATE).parquet(path)
    stored = spark.read.schema(schemas.CALLS).parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    job = jobs.naive_daily(stored, "2022-04-11", "2022-04-11")
    assert ids(job, "convrstn_id") == ["holes", "ok"]
    plan = job._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("2022-04-11" in line for line in scans)
    said = [line for line in scans if "convrstn_sntnce" in line]
    assert len(said) == 1 and "sntnce_lang_cd" in said[0].split("ReadSchema")[1]
    assert "scor_qty" not in said[0].split("ReadSchema")[1]
    # the sentence aggregation is hash based and comes before any exchange
    lines = plan.splitlines()
    first = max(i for i, line in enumerate(lines) if "partial_count(1)" in line)
    assert "HashAggregate" in lines[first] and "SortAggregate" not in lines[first]
    assert not any("Exchange" in line for line in lines[first:])
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_large_conversations_in_extraction(spark):
    """A third of all call records share an id."""
    rows = [call("big", [("ANI", f"416{i:07d}")], [f"t{i % 3}"], [sentence(f"im moving {i}", 2 * i), sentence("hi", 2 * i + 1, "AGENT")]) for i in range(100)]
    rows += [call(f"c{i}", [("ANI", "416")], ["a"], TWO_PARTY) for i in range(200)]
    df = spark.createDataFrame(rows, schemas.CALLS).repartition(7)
    convs, said = jobs.extract(df, DAY, DAY)
    assert convs.filter(F.col(ID) == "big").count() == 100
    assert said.filter(F.col(ID) == "big").count() == 200
    assert convs.filter(F.col(ID) == "big").first()["topics"] == "t0,t1,t2"
    found = jobs.naive_daily(df, DAY, DAY)
    assert found.count() == 300 and found.select("convrstn_id").distinct().count() == 201


def test_calls_are_stored_without_an_exchange(spark, tmp_path):
    """Each task writes its own files of a date: rows of two input files stay in two files."""
    from catalog import views as V

    for part in range(2):
        rows = [(30 * i + part * 300, "one two. three\nfour", "en", "web", 19) for i in range(3)]
        one = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
        one.write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        stored = V.calls(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert stored.count() == 6
    assert len(stored.inputFiles()) == 2
