"""Queries over sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift import schemas
from callsift.functions.regex import any_match
from callsift.operators import calls as C
from callsift.operators import reports as R
from callsift.plans import jobs
from callsift.session import shared_path
from callsift.sources import readers, sinks
from catalog import views as V
from catalog.registry import query

ID = C.ID


@query(
    "s1_sql_text",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders "
    "WHERE o_totalprice >= 1000 GROUP BY 1",
)
def s1(spark, d):
    V.table(spark, d, "orders").createOrReplaceTempView("callsift_orders")
    return readers.run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n, "
        "round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total "
        "FROM callsift_orders WHERE o_totalprice >= :low GROUP BY o_orderstatus",
        args={"low": 1000},
    )


@query(
    "s2_calls_between",
    "SELECT call_convrstn_id, CAST(call_convrstn_dt AS VARCHAR) AS day FROM cb "
    "WHERE call_convrstn_dt BETWEEN DATE '2022-04-05' AND DATE '2022-04-24'",
    ["cb"],
)
def s2(spark, d):
    found = C.calls_between(V.calls(spark, d), "2022-04-05", "2022-04-24")
    return found.select(ID, F.col(C.DATE).cast("string").alias("day"))


@query(
    "s3_default_window",
    "SELECT call_convrstn_id, CAST(call_convrstn_dt AS VARCHAR) AS day FROM cb "
    "WHERE call_convrstn_dt = DATE '2022-04-15' - 1",
    ["cb"],
)
def s3(spark, d):
    lo, hi = C.default_window(today=F.lit("2022-04-15").cast("date"))
    found = C.calls_between(V.calls(spark, d), lo, hi)
    return found.select(ID, F.col(C.DATE).cast("string").alias("day"))


@query("s4_csv_comma", "SELECT * FROM u", ["u"])
def s4(spark, d):
    path = shared_path(spark, "csv")
    sinks.export_csv(V.utterances(spark, d), path)
    rows = readers.read_csv(
        spark,
        path,
        f"{ID} string, sntnce string, sntnce_ts bigint, sntnce_partcpnt_role string",
        multi_line=True,
    )
    # an empty field and a missing one look alike in a file
    return rows.na.fill("", ["sntnce"])


@query(
    "s5_csv_semicolon",
    "SELECT call_convrstn_id, CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date, "
    "coalesce(bus_bacct_num, '') AS bus_bacct_num, telephone FROM facts",
    ["facts"],
)
def s5(spark, d):
    path = shared_path(spark, "csv")
    rows = V.conversation_facts(spark, d).select(
        ID, F.col("call_convrstn_date").cast("string").alias("call_convrstn_date"), "bus_bacct_num", "telephone"
    )
    sinks.export_csv(rows, path, sep=";")
    schema = f"{ID} string, call_convrstn_date string, bus_bacct_num string, telephone string"
    return readers.read_csv(spark, path, schema, sep=";", blank=True)


@query(
    "s6_area_codes",
    f"SELECT {V.province_sql('telephone')} AS pr_name, count(*) AS n FROM facts GROUP BY 1",
    ["facts"],
)
def s6(spark, d):
    path = shared_path(spark, "codes")
    codes = spark.createDataFrame(sorted(fv.AREA_CODES.items()), "code string, prvnce string")
    sinks.export_csv(codes, path)
    lookup = readers.read_area_codes(spark, path)
    found = C.with_province(V.conversation_facts(spark, d), "telephone", lookup)
    joined = C.with_province_by_join(V.conversation_facts(spark, d), readers.area_codes(spark, path))
    # the join form gives the same; each half comes from one of the two
    odd = F.pmod(F.xxhash64(ID), F.lit(2)) == 1
    return R.row_count(found.filter(odd).unionByName(joined.filter(~odd)).groupBy("pr_name"))


_WORD_SQL = r"SELECT DISTINCT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents"


@query(
    "s7_stopwords",
    f"SELECT word FROM ({_WORD_SQL}) WHERE word <> '' UNION SELECT unnest({V.sql_list(fv.FILLER_WORDS)})",
)
def s7(spark, d):
    path = shared_path(spark, "words")
    lines = V.table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), r"(?dU)\s+")))
    lines.distinct().write.text(path)
    return readers.stopwords(spark, path, fv.FILLER_WORDS)


def _pattern_counts_sql(families):
    parts = [
        f"SELECT '{f}' AS family, {i} AS ord, count(*) FILTER (WHERE regexp_matches(sntnce, {V.sql_text(p)})) AS n FROM u"
        for f, ps in families.items()
        for i, p in enumerate(ps)
    ]
    return " UNION ALL ".join(parts)


@query("s8_pattern_pack", _pattern_counts_sql(fv.PATTERNS), ["u"])
def s8(spark, d):
    """Sentences that each pattern of the pack occurs in: one pass over the text."""
    families, _, _ = readers.read_pack()
    said = V.utterances(spark, d)
    flat = [(f, i, p) for f, ps in families.items() for i, p in enumerate(ps)]
    counts = said.agg(
        *[F.count_if(any_match(F.col("sntnce"), [p])).alias(f"{f}_{i}") for f, i, p in flat]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("family"), F.lit(i).alias("ord"), F.col(f"{f}_{i}").alias("n")
                    )
                    for f, i, _ in flat
                ]
            )
        )
    )


_GEO = r"""'(?:(?:\s|^|\.|\,)(' || name || ')(?:\s|$|\.|\,|\?|\!|\;))'"""


@query(
    "s9_geo_pack",
    f"""SELECT family, {_GEO} AS pattern FROM (
      SELECT DISTINCT 'country' AS family, trim(lower(unnest(string_split(c_name || '/' || c_mktsegment, '/')))) AS name FROM customer
      UNION ALL SELECT DISTINCT 'nationality', trim(lower(c_mktsegment)) FROM customer
      UNION ALL SELECT DISTINCT 'language', trim(lower(n)) FROM (
        SELECT unnest(string_split(n_name || ' / ' || r_name, '/')) AS n FROM nation JOIN region ON n_regionkey = r_regionkey)
      UNION ALL SELECT 'region', trim(lower(s_name)) FROM supplier
      UNION ALL SELECT 'region_people', trim(lower(s_name || ' people')) FROM supplier) WHERE name <> ''""",
)
def s9(spark, d):
    customer = V.table(spark, d, "customer").select(
        F.concat_ws("/", "c_name", "c_mktsegment").alias("country"),
        F.col("c_mktsegment").alias("nationality"),
        F.lit("").alias("language"),
    )
    spoken = V.table(spark, d, "nation").join(
        V.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.lit("").alias("country"),
        F.lit("").alias("nationality"),
        F.concat_ws(" / ", "n_name", "r_name").alias("language"),
    )
    regions = V.table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.concat("s_name", F.lit(" people")).alias("population")
    )
    return readers.geo_pack(customer.unionByName(spoken), regions)


@query("s10_json_object", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s10(spark, d):
    path = shared_path(spark, "json")
    nations = V.table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nations.write.option("maxRecordsPerFile", 1).json(path)  # one object per file
    return readers.read_json(spark, path, must_exist=True).select(*nations.columns)


def _located(spark, name):
    return f"callsift_{name}_{uuid.uuid4().hex}"


@query(
    "s11_read_detections",
    f"SELECT call_convrstn_id AS convrstn_id, 'moves' AS topic, 1.0::DOUBLE AS detection_score FROM u "
    f"WHERE {V.NAIVE_SQL} GROUP BY 1",
    ["u"],
)
def s11(spark, d):
    path = shared_path(spark, "detections")
    found = jobs.with_facts(jobs.detect_naive(V.utterances(spark, d)), V.conversation_facts(spark, d))
    sinks.export_parquet(sinks.detection_rows(found), path)
    return readers.read_table(spark, path).select("convrstn_id", "topic", "detection_score")


_EXAMPLES_SQL = (
    f"SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un "
    f"WHERE sntnce_partcpnt_role = 'END_USER' AND {V.any_sql('sntnce', [p for ps in fv.PATTERNS.values() for p in ps])}"
)
_STILL_SQL = (
    f"SELECT * FROM ({_EXAMPLES_SQL}) WHERE text <> '' AND "
    f"{V.any_sql('text', [p for ps in fv.PATTERNS.values() for p in ps])}"
)


@query("s12_read_examples", f"SELECT count(*) AS n FROM ({_STILL_SQL})", ["un"])
def s12(spark, d):
    path = shared_path(spark, "examples")
    sinks.export_parquet(sinks.example_rows(jobs.label_matches(V.utterances(spark, d))), path)
    return R.row_count(readers.read_table(spark, path))


@query(
    "s13_training_data",
    "SELECT sntnce, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS movehit FROM "
    "(SELECT lower(text) AS sntnce, quality FROM documents JOIN labels USING (doc_id))",
)
def s13(spark, d):
    path = shared_path(spark, "training")
    rows = V.table(spark, d, "documents").join(V.table(spark, d, "labels"), "doc_id").select(
        F.lower("text").alias("sntnce"), F.col("quality").alias("movehit")
    )
    sinks.export_csv(rows, path)
    found, words, tags = readers.read_training(spark, path, schemas.TRAINING_TEXT, multi_line=True)
    assert set(words) == set(fv.FILLER_WORDS) and tags == fv.TAGS
    return found


# --- sinks ---------------------------------------------------------------------------


_DETECTED_SQL = f"""SELECT call_convrstn_id AS convrstn_id,
    CAST(call_convrstn_date AS VARCHAR) AS call_date, bus_bacct_num AS ban,
    CASE WHEN bus_bacct_num_src_id <> 0 THEN bus_bacct_num_src_id END AS src_id,
    CASE WHEN telephone <> '' THEN telephone END AS telephone,
    'moves' AS topic, 1.0::DOUBLE AS detection_score
    FROM (SELECT DISTINCT call_convrstn_id FROM u WHERE {V.NAIVE_SQL}) JOIN facts USING (call_convrstn_id)"""


def _detected_rows(spark, d):
    found = jobs.with_facts(jobs.detect_naive(V.utterances(spark, d)), V.conversation_facts(spark, d))
    return sinks.detection_rows(found)


def _shown(rows):
    return rows.withColumn("call_date", F.col("call_date").cast("string")).drop("gcp_refresh_date")


@query("k1_detection_table", _DETECTED_SQL, ["u", "facts"])
def k1(spark, d):
    name = _located(spark, "detections")
    sinks.load_detections(
        spark,
        name,
        _detected_rows(spark, d),
        location=shared_path(spark, "table"),
    )
    return _shown(sinks.stored(spark, name))


@query("k2_example_table", _STILL_SQL, ["un"])
def k2(spark, d):
    name = _located(spark, "examples")
    sinks.load_examples(
        spark,
        name,
        jobs.label_matches(V.utterances(spark, d)),
        location=shared_path(spark, "table"),
    )
    return sinks.stored(spark, name)


@query(
    "k3_upsert_detections",
    f"""SELECT call_convrstn_id AS convrstn_id, CASE WHEN max(CASE WHEN {V.NAIVE_SQL} THEN 1 ELSE 0 END) = 1
        THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS detection_score FROM u GROUP BY 1""",
    ["u"],
)
def k3(spark, d):
    """All conversations at a low score first, then the detected ones, twice."""
    name = _located(spark, "detections")
    place = shared_path(spark, "table")
    facts = V.conversation_facts(spark, d)
    before = facts.withColumnRenamed(ID, "conv_id").withColumn("detection_score", F.lit(0.25))
    sinks.load_detections(spark, name, sinks.detection_rows(before), place)
    for _ in range(2):
        sinks.load_detections(spark, name, _detected_rows(spark, d), place)
    return readers.read_table(spark, name).select("convrstn_id", "detection_score")


@query(
    "k4_upsert_examples",
    f"""SELECT call_convrstn_id, chunk_id, coalesce(m.text, un.sntnce) AS text FROM un
        LEFT JOIN ({_STILL_SQL}) m USING (call_convrstn_id, chunk_id)""",
    ["un"],
)
def k4(spark, d):
    """All sentences first, then the examples in their place, twice."""
    name, place = _located(spark, "examples"), shared_path(spark, "table")
    sinks.load_examples(spark, name, V.numbered(spark, d).withColumnRenamed("sntnce", "text"), place)
    for _ in range(2):
        sinks.load_examples(spark, name, jobs.label_matches(V.utterances(spark, d)), place)
    return sinks.stored(spark, name)


@query("k5_detection_rows", _DETECTED_SQL, ["u", "facts"])
def k5(spark, d):
    return _shown(_detected_rows(spark, d))


@query("k6_example_rows", "SELECT call_convrstn_id, chunk_id, sntnce AS text FROM un", ["un"])
def k6(spark, d):
    return sinks.example_rows(V.numbered(spark, d).withColumnRenamed("sntnce", "text"))


@query(
    "k7_file_exports",
    "SELECT call_convrstn_id, sntnce_partcpnt_role, count(*) AS n FROM u GROUP BY ALL",
    ["u"],
)
def k7(spark, d):
    path = shared_path(spark, "export")
    sinks.export_parquet(V.utterances(spark, d), path, ["sntnce_partcpnt_role"])
    stored = readers.read_table(spark, path)
    return R.row_count(
        stored.groupBy(F.col(ID).cast("string").alias(ID), "sntnce_partcpnt_role")
    )


@query(
    "k8_stored_model",
    """SELECT 0 AS changed, count(*) AS stored_rows, 1 AS logged,
        count(*) FILTER (WHERE part = 'test') AS test_rows FROM (
        SELECT CASE WHEN row_number() OVER (ORDER BY vec_id * 2654435761 % 1000003, vec_id)
            <= ceil(count(*) OVER () * CAST(0.15 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part FROM embeddings)""",
)
def k8(spark, d):
    """Model, data and log are stored and read back; the model predicts as before."""
    from callsift.operators import learning as L
    from catalog.learning_jobs import _halves

    path, names = shared_path(spark, "model"), [f"v{i}" for i in range(64)]
    train, test = _halves(spark, d)
    model, log = L.fit_best(train, test, names, grid=None)
    sinks.save_model(model.model, f"{path}/model")
    sinks.save_data(train, test, f"{path}/data")
    sinks.save_log(log, f"{path}/log")
    data = readers.read_table(spark, f"{path}/data")
    again = jobs.load_classifier(names, f"{path}/model").predict(data).select("vec_id", F.col("prediction").alias("again"))
    both = model.predict(data).select("vec_id", "part", "prediction").join(again, "vec_id")
    logged = spark.read.json(f"{path}/log").count()
    return both.agg(
        F.count(F.when(F.col("again") != F.col("prediction"), 1)).cast("int").alias("changed"),
        F.count(F.lit(1)).alias("stored_rows"),
        F.lit(logged).cast("int").alias("logged"),
        F.count(F.when(F.col("part") == "test", 1)).alias("test_rows"),
    )
