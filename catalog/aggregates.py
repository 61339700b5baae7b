"""Queries over aggregations and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.operators import calls as C
from callsift.operators import learning as L
from callsift.operators import reports as R
from callsift.operators.calls import ID
from callsift.plans import jobs
from catalog import views as V
from catalog.filters_joins import REPORT_SQL, SIZING_SQL, sizing_input
from catalog.registry import query


@query("a1_joined_labels", "SELECT call_convrstn_id, virtualqueues, agnt_id, telephone FROM attrs", ["attrs"])
def a1(spark, d):
    return C.label_attributes(V.calls(spark, d)).select(ID, "virtualqueues", "agnt_id", "telephone")


@query("a2_highest_account", "SELECT call_convrstn_id, bus_bacct_num FROM attrs", ["attrs"])
def a2(spark, d):
    return C.label_attributes(V.calls(spark, d)).select(ID, "bus_bacct_num")


@query("a3_topics", "SELECT * FROM topics", ["topics"])
def a3(spark, d):
    return C.topics(V.calls(spark, d))


@query("a4_two_party", "SELECT * FROM el_len", ["el_len"])
def a4(spark, d):
    return C.two_party(C.sentences(V.calls(spark, d)), V.MIN_EXCHANGE)


@query("a5_single_language", "SELECT * FROM el_lang", ["el_lang"])
def a5(spark, d):
    return C.single_language(C.sentences(V.calls(spark, d)), V.ALLOWED_LANG)


@query(
    "a6_best_score",
    "SELECT label AS conv_id, max(CAST(embedding[1] AS DOUBLE)) AS detection_score FROM embeddings GROUP BY 1",
)
def a6(spark, d):
    from callsift.operators.rules import best_scores

    scored = V.table(spark, d, "embeddings").select(
        F.col("label").alias("conv_id"), F.col("embedding")[0].cast("double").alias("detection_score")
    )
    return best_scores(scored)


@query(
    "a9_per_date",
    f"""SELECT CAST(call_convrstn_date AS VARCHAR) AS date, count(DISTINCT call_convrstn_id) AS cnt_unique_conv_id,
        count(DISTINCT bus_bacct_num) AS cnt_unique_ban
        FROM ({REPORT_SQL}) LEFT JOIN facts USING (call_convrstn_id) GROUP BY 1""",
    ["un", "facts"],
)
def a9(spark, d):
    found = R.with_call_facts(R.match_report(V.numbered(spark, d)), V.conversation_facts(spark, d))
    return R.per_date(found).withColumn("date", F.col("date").cast("string"))


_FUNNEL = f"""SELECT {{name}} AS province, count(*) AS total_conv, count(*) FILTER (WHERE e) AS conv_in_english,
    count(*) FILTER (WHERE e AND iss_max > 0.75) AS conv_with_high_iss,
    count(*) FILTER (WHERE e AND iss_max > 0.75 AND num IS NOT NULL) AS conv_with_known_identification
    FROM (SELECT *, call_convrstn_id IN (SELECT call_convrstn_id FROM u) AS e FROM ({SIZING_SQL}))"""
SIZING_ORACLE = (
    _FUNNEL.format(name="pr_name")
    + " WHERE pr_name IS NOT NULL GROUP BY pr_name UNION ALL "
    + _FUNNEL.format(name="'ALL'")
)


@query("a10_sizing", SIZING_ORACLE, ["u"])
def a10(spark, d):
    return R.sizing(sizing_input(spark, d), V.utterances(spark, d))


@query(
    "a11_describe",
    """SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min,
       quantile_cont(n, 0.25)::DOUBLE AS p25, quantile_cont(n, 0.5)::DOUBLE AS p50, quantile_cont(n, 0.75)::DOUBLE AS p75, max(n) AS max
       FROM (SELECT count(sntnce) AS n FROM sn GROUP BY call_convrstn_id)""",
    ["sn"],
)
def a11(spark, d):
    counts = R.sentence_counts(C.sentences(V.calls(spark, d)))
    return (
        R.describe(counts, "sntnce")
        .withColumn("mean", F.round("mean", 6))
        .withColumn("std", F.round("std", 6))
    )


@query(
    "a12_class_counts",
    "SELECT quality, count(*) AS n, min(count(*)) OVER () AS smallest FROM labels GROUP BY quality",
)
def a12(spark, d):
    counts = L.class_counts(V.table(spark, d, "labels"), "quality")
    return counts.withColumn("smallest", counts.agg(F.min("n")).scalar())


def _predicted(spark, d):
    return V.table(spark, d, "labels").select(
        "doc_id",
        F.col("quality").alias("label"),
        ((F.col("doc_id") * 7 + F.col("toxic")) % 3 == 0).cast("int").alias("pred"),
        F.when(F.col("doc_id") % 4 == 0, "test").otherwise("train").alias("part"),
    )


_PRED_SQL = """SELECT doc_id, quality AS label, CASE WHEN (doc_id * 7 + toxic) % 3 = 0 THEN 1 ELSE 0 END AS pred,
    CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END AS part FROM labels"""


@query(
    "a13_accuracy",
    f"SELECT part, round(avg(CASE WHEN label = pred THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy FROM ({_PRED_SQL}) GROUP BY 1",
)
def a13(spark, d):
    found = L.accuracy(_predicted(spark, d), "label", "pred", ["part"])
    return found.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "a14_confusion_matrix",
    f"""SELECT label, count(*) FILTER (WHERE pred = 0) AS predicted_0, count(*) FILTER (WHERE pred = 1) AS predicted_1
        FROM ({_PRED_SQL}) GROUP BY 1""",
)
def a14(spark, d):
    found = L.confusion(_predicted(spark, d), "label", "pred")
    return found.withColumnsRenamed({"0": "predicted_0", "1": "predicted_1"})


@query(
    "a15_detection_rate",
    f"""SELECT count(DISTINCT call_convrstn_id) FILTER (WHERE {V.NAIVE_SQL}) AS n_detected,
        count(DISTINCT call_convrstn_id) AS n_total,
        round(round_even(count(DISTINCT call_convrstn_id) FILTER (WHERE {V.NAIVE_SQL}) / count(DISTINCT call_convrstn_id), 2) * 100, 6) AS pct FROM u""",
    ["u"],
)
def a15(spark, d):
    said = V.utterances(spark, d)
    found = jobs.detect_naive(said).withColumnRenamed("conv_id", ID)
    return R.detection_rate(said, found).withColumn("pct", F.round("pct", 6))


@query(
    "a16_row_counts",
    "SELECT (SELECT count(*) FROM convs WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM es)) AS n_conversations, "
    "(SELECT count(*) FROM es WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM convs)) AS n_sentences",
    ["convs", "es"],
)
def a16(spark, d):
    convs, said = jobs.extract(V.calls(spark, d), V.FIRST_DAY, V.LAST_DAY)
    return R.row_count(convs, "n_conversations").withColumn(
        "n_sentences", R.row_count(said).scalar()
    )


@query("a17_provinces", "SELECT DISTINCT pr_name FROM convs", ["convs"])
def a17(spark, d):
    convs = jobs.conversation_facts(V.calls(spark, d), jobs.Extraction())
    return R.provinces(convs)
