"""From nested call records to eligible conversations and sentences
(S2, S3, F1-F7, J1-J6, A1-A5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv

ID = "call_convrstn_id"
DATE = "call_convrstn_dt"


def default_window(
    start: str | None = None, end: str | None = None, today: Column | None = None
) -> tuple[Column, Column]:
    """S3: the date range of a daily job; yesterday unless stated otherwise."""
    yesterday = F.date_sub(today if today is not None else F.current_date(), 1)
    hi = F.lit(end).cast("date") if end else yesterday
    lo = F.lit(start).cast("date") if start else hi
    return lo, hi


def calls_between(calls: DataFrame, lo, hi) -> DataFrame:
    """Calls of an inclusive date range (prunes date partitions)."""
    return calls.filter(F.col(DATE).between(lo, hi))


# --- labels and issues -------------------------------------------------------


def explode_labels(calls: DataFrame) -> DataFrame:
    """One row per label; calls without labels disappear."""
    return calls.select(ID, F.inline("convrstn_label"))


def label_columns(key: Column, value: Column) -> dict[str, Column]:
    """a label's value in the column its key belongs to, else null."""
    text = value.cast("string")
    filled = F.nullif(text, F.lit(""))
    return {
        "virtualqueue": F.when(key.isin(fv.VIRTUAL_QUEUE_KEYS), filled),
        "ban": F.when(
            F.lower(key).isin(fv.ACCOUNT_KEYS_LOWER) & ~text.isin(fv.ACCOUNT_SENTINELS), text
        ),
        "agnt_id": F.when(key == fv.AGENT_KEY, filled),
        "telephone": F.when(F.upper(key).isin(fv.TELEPHONE_KEYS_UPPER), filled),
    }


def route_labels(labels: DataFrame) -> DataFrame:
    routed = label_columns(F.col("label_key"), F.col("label_val"))
    return labels.select(ID, *[c.alias(n) for n, c in routed.items()])


def joined_distinct(column: str | Column) -> Column:
    """A1: distinct non-null values, sorted and comma-joined; null if none.

    Sets are merged in the map tasks, so repeated values never travel.
    """
    found = F.collect_set(column)
    return F.when(F.size(found) > 0, F.array_join(F.array_sort(found), ","))


def label_attributes(calls: DataFrame) -> DataFrame:
    """A1, A2: one row of label attributes per conversation that has labels."""
    return (
        route_labels(explode_labels(calls))
        .groupBy(ID)
        .agg(
            joined_distinct("virtualqueue").alias("virtualqueues"),
            F.max("ban").alias("bus_bacct_num"),
            joined_distinct("agnt_id").alias("agnt_id"),
            joined_distinct("telephone").alias("telephone"),
        )
    )


def topics(calls: DataFrame) -> DataFrame:
    """Distinct issue names per conversation that has issues."""
    return (
        calls.select(ID, F.inline("convrstn_iss"))
        .groupBy(ID)
        .agg(joined_distinct("iss_nm").alias("topics"))
    )


def known_identity(df: DataFrame) -> DataFrame:
    """rows with an account number or a telephone."""
    return df.filter(F.col("bus_bacct_num").isNotNull() | F.col("telephone").isNotNull())


def call_attributes(calls: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A1-A3 in one pass: label attributes and topics of the conversations
    that have labels as well as issues.

    Labels and issues of a call are exploded together, so the calls are read
    and shuffled once.  ``keep`` names columns that are constant per
    conversation.
    """
    none = F.lit(None).cast("string")
    labels = F.transform(
        "convrstn_label",
        lambda x: F.struct(
            x["label_key"].alias("label_key"),
            x["label_val"].alias("label_val"),
            none.alias("iss_nm"),
            F.lit(True).alias("is_label"),
        ),
    )
    issues = F.transform(
        "convrstn_iss",
        lambda x: F.struct(
            none.alias("label_key"),
            none.alias("label_val"),
            x["iss_nm"].alias("iss_nm"),
            F.lit(False).alias("is_label"),
        ),
    )
    rows = calls.select(
        ID,
        *keep,
        F.inline(F.concat(F.coalesce(labels, F.array()), F.coalesce(issues, F.array()))),
    )
    routed = label_columns(F.col("label_key"), F.col("label_val"))
    return (
        rows.groupBy(ID)
        .agg(
            F.count_if("is_label").alias("_labels"),
            F.count_if(~F.col("is_label")).alias("_issues"),
            F.max(routed["ban"]).alias("bus_bacct_num"),
            *[
                joined_distinct(routed[n]).alias(out)
                for n, out in (
                    ("virtualqueue", "virtualqueues"),
                    ("agnt_id", "agnt_id"),
                    ("telephone", "telephone"),
                )
            ],
            joined_distinct("iss_nm").alias("topics"),
            *[F.max(k).alias(k) for k in keep],
        )
        .filter((F.col("_labels") > 0) & (F.col("_issues") > 0))
        .drop("_labels", "_issues")
    )


def conversations(
    calls: DataFrame, only: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Call rows with their label attributes and topics.

    The call rows, where an id may repeat without bound, meet a table that
    holds each id once.  ``only`` limits the result to its ids, and brings the
    columns ``keep`` along.
    """
    described = calls if only is None else calls.join(only.select(ID, *keep), ID)
    attributes = known_identity(call_attributes(described, keep))
    return calls.select(
        ID, F.col(DATE).alias("call_convrstn_date"), "bus_bacct_num_src_id"
    ).join(attributes, ID)


def province(number: Column, area_codes: Mapping[str, str] = fv.AREA_CODES) -> Column:
    """province of a telephone number, by its first three characters.

    A membership test per province keeps the lookup inside the projection.
    """
    prefix = F.substring(number.cast("string"), 1, 3)
    by_province: dict[str, list[str]] = {}
    for code, name in area_codes.items():
        by_province.setdefault(name, []).append(str(code))
    found = F.lit(None).cast("string")
    for name, codes in by_province.items():
        found = F.when(prefix.isin(codes), F.lit(name)).otherwise(found)
    return found


def with_province(
    df: DataFrame, number: str = "telephone", area_codes: Mapping[str, str] = fv.AREA_CODES
) -> DataFrame:
    return df.withColumn("pr_name", province(F.col(number), area_codes))


def with_province_by_join(df: DataFrame, codes: DataFrame, number: str = "telephone") -> DataFrame:
    """F7 with a table ``(code, prvnce)`` of any size, one row for each code."""
    prefix = F.substring(F.col(number).cast("string"), 1, 3)
    named = codes.select(F.col("code").alias("_code"), F.col("prvnce").alias("pr_name"))
    return df.join(named, prefix == F.col("_code"), "left").drop("_code")


# --- sentences ---------------------------------------------------------------


# column of a sentence -> field of the nested record
SENTENCE_FIELDS = {
    "sntnce": "sntnce",
    "sntnce_ts": "sntnce_create_nnsec_qty",
    "sntnce_lang_cd": "sntnce_lang_cd",
    "sntnce_partcpnt_role": "sntnce_partcpnt_role",
    "sntnce_sntmnt_scor_qty": "sntnce_sntmnt_scor_qty",
    "sntnce_sntmnt_mgntd_qty": "sntnce_sntmnt_mgntd_qty",
}
SAID_BY_WHOM = ("sntnce", "sntnce_lang_cd", "sntnce_partcpnt_role")
# place of a sentence in the nested record, from 0: the spoken order of sentences of one time
PLACE = "sntnce_place"
SAID_WHEN = ("sntnce_ts", *SAID_BY_WHOM)


def spoken_order(said: DataFrame) -> list[str]:
    """What sentences of a conversation are sorted by: their time, then their place, if it is known."""
    return ["sntnce_ts", *[c for c in said.columns if c == PLACE]]


def sentences(calls: DataFrame, columns: Sequence[str] = tuple(SENTENCE_FIELDS)) -> DataFrame:
    """Valid sentences in lower case.

    Only the fields of ``columns`` are read from the nested records; text, role
    and language have to be among them.  ``PLACE`` may be one of them.
    """
    stored = [c for c in columns if c != PLACE]
    fields = F.arrays_zip(
        *[F.col(f"convrstn_sntnce.{SENTENCE_FIELDS[c]}").alias(c) for c in stored]
    )
    if PLACE in columns:
        said = calls.select(ID, F.posexplode(fields).alias(PLACE, "_said")).select(ID, PLACE, "_said.*")
        said = said.toDF(ID, PLACE, *stored).select(ID, *columns)
    else:
        said = calls.select(ID, F.inline(fields)).toDF(ID, *columns)
    return said.filter(
        (F.col("sntnce") != "")
        & (F.col("sntnce") != "\n")
        & F.col("sntnce_partcpnt_role").isNotNull()
        & F.col("sntnce_lang_cd").isNotNull()
    ).withColumn("sntnce", F.lower("sntnce"))


def role_profile(said: DataFrame, **extra: Column) -> DataFrame:
    """Sentences per conversation, role and language code.

    This is the only pass over the sentences that eligibility needs; what it
    emits is one small row per role and conversation in each map task.  Codes
    are keys, not minima: a string minimum would have Spark sort the sentences.
    """
    return said.groupBy(ID, "sntnce_partcpnt_role", "sntnce_lang_cd").agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in extra.items()]
    )


def two_party(said: DataFrame, min_exchange: int) -> DataFrame:
    """A4: conversations in which at least two roles speak often enough."""
    return (
        said.groupBy(ID, "sntnce_partcpnt_role")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(ID)
        .agg(F.count_if(F.col("n") >= min_exchange).alias("cnt_partcpnt"))
        .filter(F.col("cnt_partcpnt") > 1)
    )


def single_language(said: DataFrame, allowed_lang: str) -> DataFrame:
    """A5: conversations in exactly one language code, the allowed one."""
    return (
        said.groupBy(ID, "sntnce_lang_cd")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(ID)
        .agg(F.min("sntnce_lang_cd").alias("min_lang"), F.max("sntnce_lang_cd").alias("_hi"))
        .filter((F.col("min_lang") == F.col("_hi")) & (F.lower("min_lang") == allowed_lang))
        .drop("_hi")
    )


def eligible_ids(said: DataFrame, min_exchange: int, allowed_lang: str) -> DataFrame:
    """A4 and A5 together, from one pass: ids of the eligible conversations."""
    return eligible(role_profile(said), min_exchange, allowed_lang).select(ID)


def eligible(
    profile: DataFrame, min_exchange: int, allowed_lang: str, **extra: Column
) -> DataFrame:
    """Conversations of a profile that are in one language, the allowed one,
    and have two roles that speak often enough.

    Where there is one language, a profile row is a whole role.
    """
    return (
        profile.groupBy(ID)
        .agg(
            F.count_if(F.col("n") >= min_exchange).alias("_roles"),
            F.min("sntnce_lang_cd").alias("_lo"),
            F.max("sntnce_lang_cd").alias("_hi"),
            *[c.alias(n) for n, c in extra.items()],
        )
        .filter(
            (F.col("_roles") > 1)
            & (F.col("_lo") == F.col("_hi"))
            & (F.lower("_lo") == allowed_lang)
        )
        .drop("_roles", "_lo", "_hi")
    )


def sentiment(score: Column, magnitude: Column) -> Column:
    """F5"""
    return score * magnitude


def eligible_sentences(said: DataFrame, ids: DataFrame) -> DataFrame:
    """Sentences of the eligible conversations, with their sentiment, and their place if it is known."""
    return said.join(ids, ID, "left_semi").select(
        ID,
        "sntnce",
        *spoken_order(said),
        "sntnce_partcpnt_role",
        sentiment(F.col("sntnce_sntmnt_scor_qty"), F.col("sntnce_sntmnt_mgntd_qty")).alias(
            "sntnce_sntmnt"
        ),
    )


def with_both(convs: DataFrame, said: DataFrame, key: str = ID) -> tuple[DataFrame, DataFrame]:
    """Conversations that have sentences, and sentences that have one."""
    return (
        convs.join(said.select(key).distinct(), key, "left_semi"),
        said.join(convs.select(key).distinct(), key, "left_semi"),
    )


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F16: configured columns, in that order."""
    return df.select(*columns)
