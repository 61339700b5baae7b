"""Counts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.regex import all_matches
from callsift.operators.calls import ID
from callsift.operators.rules import Pack, mover_candidate

REPORT_FAMILIES = {
    "movers": "mover_match",
    "cancel": "cancel_match",
    "holiday": "holiday_match",
    "expression": "expression_match",
    "things": "things_match",
    "negation": "negation_match",
}


def match_report(said: DataFrame, pack: Pack = fv.PATTERNS) -> DataFrame:
    """Matches of six families for every customer sentence about moving."""
    text = F.col("sntnce")
    return said.filter(mover_candidate(text, F.col("sntnce_partcpnt_role"), pack)).select(
        ID,
        "chunk_id",
        text.alias("text"),
        *[
            F.array_join(all_matches(text, pack[family]), ";").alias(name)
            for family, name in REPORT_FAMILIES.items()
        ],
    )


def with_call_facts(matches: DataFrame, convs: DataFrame) -> DataFrame:
    """Account and date of every match, if known."""
    facts = convs.select(ID, "bus_bacct_num", "call_convrstn_date")
    return matches.join(facts, ID, "left")


def per_date(matches: DataFrame) -> DataFrame:
    """Conversations and accounts per call date.

    Each counted id is reduced to one row per date before the final count.
    """
    return (
        matches.filter(F.col("call_convrstn_date").isNotNull())
        .groupBy(F.col("call_convrstn_date").alias("date"))
        .agg(
            F.count_distinct(ID).alias("cnt_unique_conv_id"),
            F.count_distinct("bus_bacct_num").alias("cnt_unique_ban"),
        )
    )


def high_issue(score: Column, limit: float = fv.HIGH_ISSUE_SCORE) -> Column:
    """F15"""
    return score.isNotNull() & (score > limit)


def identified(number: Column) -> Column:
    """F15"""
    return number.isNotNull()


def flag_known(df: DataFrame, ids: DataFrame, key: str = ID, out: str = "known") -> DataFrame:
    """Whether the row's id is among the given ones."""
    marks = ids.select(key).distinct().withColumn(out, F.lit(True))
    return df.join(marks, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def sizing(
    convs: DataFrame,
    said: DataFrame,
    key: str = ID,
    score: str = "iss_max",
    number: str = "num",
) -> DataFrame:
    """A10: conversations per province and overall, through four filters in turn."""
    flagged = flag_known(convs, said, key, "_english")
    english = F.col("_english")
    high = english & high_issue(F.col(score))
    known = high & identified(F.col(number))
    rows = flagged.select(
        "pr_name", english.alias("_e"), high.alias("_h"), known.alias("_k")
    )
    counted = rows.groupingSets([[F.col("pr_name")], []], "pr_name").agg(
        F.grouping("pr_name").alias("_all"),
        F.count(F.lit(1)).alias("total_conv"),
        F.count_if("_e").alias("conv_in_english"),
        F.count_if("_h").alias("conv_with_high_iss"),
        F.count_if("_k").alias("conv_with_known_identification"),
    )
    return counted.filter((F.col("_all") == 1) | F.col("pr_name").isNotNull()).select(
        F.when(F.col("_all") == 1, "ALL").otherwise(F.col("pr_name")).alias("province"),
        "total_conv",
        "conv_in_english",
        "conv_with_high_iss",
        "conv_with_known_identification",
    )


def sentence_counts(said: DataFrame, key: str = ID) -> DataFrame:
    return said.groupBy(key).agg(F.count("sntnce").alias("sntnce"))


def describe(counts: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles."""
    value = F.col(column)
    return counts.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.percentile(value, F.lit(0.25)).alias("p25"),
        F.percentile(value, F.lit(0.5)).alias("p50"),
        F.percentile(value, F.lit(0.75)).alias("p75"),
        F.max(value).alias("max"),
    )


def detection_rate(said: DataFrame, detected: DataFrame, key: str = ID) -> DataFrame:
    """Detected conversations, all conversations and their ratio in percent."""
    ids = flag_known(said.select(key).distinct(), detected, key, "_hit")
    return ids.agg(
        F.count_if("_hit").alias("n_detected"), F.count(F.lit(1)).alias("n_total")
    ).withColumn("pct", F.bround(F.col("n_detected") / F.col("n_total"), 2) * 100)


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """A16, S12"""
    return df.agg(F.count(F.lit(1)).alias(out))


def provinces(convs: DataFrame) -> DataFrame:
    """A17"""
    return convs.select("pr_name").distinct()


def least(df: DataFrame, order: list, n: int) -> DataFrame:
    """O2: the first ``n`` rows in an order."""
    return df.orderBy(*order).limit(n)
