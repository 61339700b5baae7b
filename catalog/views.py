"""Inputs of the registered queries, derived from the given tables.

Each view exists twice: as a DataFrame and as a DuckDB table expression.  All
of them are row-wise derivations, so they grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift import schemas
from callsift.operators.calls import DATE, ID
from callsift.operators.intents import IntentPack
from callsift.operators.ordering import number_rows
from callsift.session import apply_defaults, shared_path
from callsift.sources.readers import read_table

# utterances put in place of the invented prose, so that the rules find work
PHRASES = [
    "we are moving to toronto",
    "im moving next month",
    "we went house hunting",
    "a realestate agent called",
    "moving it now",
    "im moving the router",
    "it is moving slow",
    "they arent moving?",
    "we aren't moving.",
    "im not going to move",
    "i was moving boxes",
    "moving forward with it",
    "you moving out?",
    "moving around a lot",
    "moving me.",
    "time off moving",
    "moving across town",
    "please cancel.",
    "cancel my plan moving",
    "my internet will end",
    "stop the tv plan",
    "yes thank you",
    "",
    "hello [location] moving",
]

# patterns over strings that do occur in the prose
PROSE_PACK = {
    "link": [r"((?:^|\s)und\s)", r"(\sla\s)"],
    "stem": [r"(end)", r"(of the)"],
    "past": [r"(was )"],
}
PROSE_PATTERNS = [p for ps in PROSE_PACK.values() for p in ps]
PROSE_KEYWORDS = ["und", "la", "the", "of"]
PROSE_STOPWORDS = ["the", "and", "of", "und", "la", "que", "der", "is"]

LABEL_KEYS = (
    fv.VIRTUAL_QUEUE_KEYS + fv.ACCOUNT_KEYS_LOWER + [fv.AGENT_KEY] + fv.TELEPHONE_KEYS_UPPER
)
OTHER_CASE_KEYS = [k.upper() if k.islower() else k.lower() for k in LABEL_KEYS]
AREAS = list(fv.AREA_CODES) + ["111", "222", "333", "999"]
FIRST_DAY, LAST_DAY = "2022-04-01", "2022-04-30"
MIN_EXCHANGE, ALLOWED_LANG = 2, "en-us"
N_CHUNKS = 5
CHUNKS_PER_DOC = 12


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(apply_defaults(spark), f"{d}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


# --- sentences -----------------------------------------------------------------


def utterances(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    k = (F.col("conv_id") * 31 + F.col("turn") * 7) % 24
    return turns.select(
        F.col("conv_id").cast("string").alias(ID),
        F.when(F.col("role") == "user", pick(PHRASES, k)).otherwise(F.lower("text")).alias("sntnce"),
        F.col("turn").alias("sntnce_ts"),
        F.when(F.col("role") == "user", "END_USER")
        .when(F.col("role") == "assistant", "AGENT")
        .otherwise("SYSTEM")
        .alias("sntnce_partcpnt_role"),
    )


def numbered(spark: SparkSession, d: str) -> DataFrame:
    return number_rows(utterances(spark, d), ID, ["sntnce_ts"])


def conversation_facts(spark: SparkSession, d: str) -> DataFrame:
    """One row of facts per conversation of the utterances."""
    ids = table(spark, d, "conversations").select("conv_id").distinct()
    n = F.col("conv_id")
    area = pick(AREAS, n % len(AREAS))
    return ids.select(
        n.cast("string").alias(ID),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (n % 30).cast("int")).alias("call_convrstn_date"),
        F.when(n % 4 != 0, (n % 9).cast("string")).alias("bus_bacct_num"),
        F.when(n % 3 != 0, n % 5).alias("bus_bacct_num_src_id"),
        F.when(n % 5 == 0, F.lit("")).otherwise(F.concat(area, F.lpad(n.cast("string"), 7, "0"))).alias("telephone"),
    )


# --- nested calls ----------------------------------------------------------------


_STORED: dict[tuple[str, str], str] = {}


def calls(spark: SparkSession, d: str) -> DataFrame:
    """The nested call table, derived from all documents.

    It is stored once per session, by date, as a call table would be: queries
    then prune dates and nested fields in the scan.  Every task writes its own
    files of each date, so no row is exchanged for it.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        path = shared_path(spark, "calls")
        derived_calls(spark, d).write.partitionBy(DATE).parquet(path)
        _STORED[key] = path
    return apply_defaults(spark).read.schema(schemas.CALLS).parquet(_STORED[key])


def derived_calls(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    n = F.col("doc_id")

    def span(stop: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), stop - 1)

    def several(stop: Column, item) -> Column:
        return F.when(stop > 0, F.transform(span(stop), item)).otherwise(
            F.transform(F.slice(span(F.lit(1).cast("long")), 1, 0), item)
        )

    def label(i: Column) -> Column:
        k = (n * 5 + i * 11) % 26
        value = (
            F.when((n + i) % 11 == 0, F.lit(""))
            .when((n + i) % 11 == 1, F.lit("0000000000"))
            .otherwise(
                F.concat(
                    pick(AREAS, (n + i * 3) % len(AREAS)),
                    F.lpad(((n * 7919 + i * 31) % 10000000).cast("string"), 7, "0"),
                )
            )
        )
        return F.struct(
            F.when((n + i) % 2 == 0, pick(LABEL_KEYS, k)).otherwise(pick(OTHER_CASE_KEYS, k)).alias("label_key"),
            value.alias("label_val"),
        )

    def issue(i: Column) -> Column:
        return F.struct(F.concat(F.lit("issue_"), ((n + i * i) % 3).cast("string")).alias("iss_nm"))

    def sentence(s: Column, i0: Column) -> Column:
        i = i0.cast("long")
        said = F.when((i % 6 == 0), pick(PHRASES, (n * 31 + i * 7) % 24)).otherwise(s)
        return F.struct(
            F.when(i % 17 != 16, said).alias("sntnce"),
            (i * 1000 + n % 10).alias("sntnce_create_nnsec_qty"),
            F.when(i % 13 != 12,
                F.when((n % 7 == 0) & (i == 1), "xx")
                .when(n % 5 == 0, "fr-CA")
                .when(n % 5 == 1, "en-us")
                .otherwise("en-US"),
            ).alias("sntnce_lang_cd"),
            F.when(i % 11 != 10, F.when(i % 2 == 0, "END_USER").otherwise("AGENT")).alias(
                "sntnce_partcpnt_role"
            ),
            (((n + i) % 21 - 10) / 10.0).alias("sntnce_sntmnt_scor_qty"),
            F.when(i % 6 != 5, (i % 5) / 2.0).alias("sntnce_sntmnt_mgntd_qty"),
        )

    return docs.select(
        (n - F.when(n % 10 == 9, 1).otherwise(0)).cast("string").alias(ID),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (n % 30).cast("int")).alias("call_convrstn_dt"),
        (n % 4).alias("bus_bacct_num_src_id"),
        several(n % 7, label).alias("convrstn_label"),
        several(n % 4, issue).alias("convrstn_iss"),
        F.transform(F.split("text", "[.\n]", -1), sentence).alias("convrstn_sntnce"),
    )


# --- vectors ------------------------------------------------------------------------


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """Every embedding as a sub-sentence of a chunk of a document."""
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.floor(F.col("vec_id") / CHUNKS_PER_DOC).alias("doc_id"),
        (F.col("label") % N_CHUNKS).cast("int").alias("chunk_idx"),
        F.col("embedding").alias("vec"),
    )


def chunk_list(spark: SparkSession, d: str) -> DataFrame:
    docs = vectors(spark, d).select("doc_id").distinct()
    return docs.select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.lit(N_CHUNKS - 1))).alias("chunk_idx")
    )


def references(spark: SparkSession, d: str) -> DataFrame:
    """One reference per label, its opposite, and the intent it belongs to."""
    return (
        table(spark, d, "embeddings")
        .groupBy(F.col("label").alias("j"))
        .agg(
            F.min_by("embedding", "vec_id").alias("pos"),
            F.max_by("embedding", "vec_id").alias("neg"),
        )
        .withColumn("intent", F.concat(F.lit("i"), (F.col("j") % 3).cast("string")))
    )


def one_pack(spark: SparkSession, d: str, side: str = "pos") -> IntentPack:
    rows = references(spark, d).withColumn("intent", F.lit("all"))
    return IntentPack.from_rows(rows, "intent", "j", side)


def several_packs(spark: SparkSession, d: str, side: str = "pos") -> IntentPack:
    return IntentPack.from_rows(references(spark, d), "intent", "j", side)


# --- the same, for DuckDB -----------------------------------------------------------------


def any_sql(text: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {sql_text(p)})" for p in patterns) + ")"


def matches_sql(text: str, patterns: list[str]) -> str:
    parts = ", ".join(f"regexp_extract_all({text}, {sql_text(p)}, 0)" for p in patterns)
    return f"flatten([{parts}])"


def join_sql(values: str, sep: str = "|") -> str:
    return f"coalesce(array_to_string({values}, '{sep}'), '')"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def clean_sql(text: str) -> str:
    tokens = "|".join([*fv.TAGS, *fv.FILLER_WORDS])
    return strip_sql(f"regexp_replace(lower({text}), {sql_text('(' + tokens + ')')}, '', 'g')")


def starts_sql(text: str, pattern: str) -> str:
    p = sql_text(pattern)
    m, g = f"regexp_extract_all({text}, {p}, 0)", f"string_split_regex({text}, {p})"
    return (
        f"list_transform(range(1, len({m}) + 1), lambda k: "
        f"list_sum(list_transform({g}[1:k], lambda x: length(x))) + "
        f"coalesce(list_sum(list_transform({m}[1:k - 1], lambda x: length(x))), 0))"
    )


NAIVE_SQL = (
    f"sntnce_partcpnt_role = 'END_USER' AND {any_sql('sntnce', fv.PATTERNS['movers'])} AND NOT "
    + any_sql(
        "sntnce",
        [p for f in ("cancel", "holiday", "expression", "things") for p in fv.PATTERNS[f]],
    )
)
MOVER_SQL = f"(sntnce_partcpnt_role = 'END_USER' AND {any_sql('sntnce', fv.PATTERNS['movers'])})"
CANCEL_SQL = any_sql("sntnce", fv.PATTERNS["cancel"])
EXCLUDED_SQL = any_sql(
    "sntnce",
    [
        p
        for f in ("expression", "holiday", "things", "past", "negation")
        for p in fv.PATTERNS[f]
    ],
)

_PROVINCE_CASES = " ".join(f"WHEN '{c}' THEN '{p}'" for c, p in fv.AREA_CODES.items())


def province_sql(number: str) -> str:
    return f"CASE substr(CAST({number} AS VARCHAR), 1, 3) {_PROVINCE_CASES} END"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


CTES: dict[str, tuple[list[str], str]] = {
    "u": (
        [],
        f"""SELECT CAST(conv_id AS VARCHAR) AS call_convrstn_id,
        CASE WHEN role = 'user' THEN ({sql_list(PHRASES)})[(conv_id * 31 + turn * 7) % 24 + 1]
             ELSE lower(text) END AS sntnce,
        turn AS sntnce_ts,
        CASE role WHEN 'user' THEN 'END_USER' WHEN 'assistant' THEN 'AGENT' ELSE 'SYSTEM' END
            AS sntnce_partcpnt_role
        FROM conversations""",
    ),
    "un": (
        ["u"],
        "SELECT *, row_number() OVER (PARTITION BY call_convrstn_id ORDER BY sntnce_ts) - 1 "
        "AS chunk_id FROM u",
    ),
    "facts": (
        [],
        f"""SELECT CAST(n AS VARCHAR) AS call_convrstn_id,
        DATE '{FIRST_DAY}' + CAST(n % 30 AS INTEGER) AS call_convrstn_date,
        CASE WHEN n % 4 <> 0 THEN CAST(n % 9 AS VARCHAR) END AS bus_bacct_num,
        CASE WHEN n % 3 <> 0 THEN n % 5 END AS bus_bacct_num_src_id,
        CASE WHEN n % 5 = 0 THEN '' ELSE
            ({sql_list(AREAS)})[n % {len(AREAS)} + 1] || lpad(CAST(n AS VARCHAR), 7, '0') END AS telephone
        FROM (SELECT DISTINCT conv_id AS n FROM conversations)""",
    ),
    "cb": (
        [],
        f"""SELECT doc_id AS n, text,
        CAST(doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) AS call_convrstn_id,
        DATE '{FIRST_DAY}' + CAST(doc_id % 30 AS INTEGER) AS call_convrstn_dt,
        doc_id % 4 AS bus_bacct_num_src_id FROM documents""",
    ),
    "lab": (
        ["cb"],
        f"""SELECT call_convrstn_id,
        CASE WHEN (n + i) % 2 = 0 THEN ({sql_list(LABEL_KEYS)})[(n * 5 + i * 11) % 26 + 1]
             ELSE ({sql_list(OTHER_CASE_KEYS)})[(n * 5 + i * 11) % 26 + 1] END AS label_key,
        CASE (n + i) % 11 WHEN 0 THEN '' WHEN 1 THEN '0000000000' ELSE
            ({sql_list(AREAS)})[(n + i * 3) % {len(AREAS)} + 1]
            || lpad(CAST((n * 7919 + i * 31) % 10000000 AS VARCHAR), 7, '0') END AS label_val
        FROM (SELECT *, unnest(range(n % 7)) AS i FROM cb)""",
    ),
    "iss": (
        ["cb"],
        """SELECT call_convrstn_id, 'issue_' || CAST((n + i * i) % 3 AS VARCHAR) AS iss_nm
        FROM (SELECT *, unnest(range(n % 4)) AS i FROM cb)""",
    ),
    "rs": (
        ["cb"],
        f"""SELECT call_convrstn_id, n, i,
        CASE WHEN i % 17 <> 16 THEN
            CASE WHEN i % 6 = 0 THEN ({sql_list(PHRASES)})[(n * 31 + i * 7) % 24 + 1] ELSE s END
        END AS sntnce,
        i * 1000 + n % 10 AS sntnce_ts,
        CASE WHEN i % 13 <> 12 THEN
            CASE WHEN n % 7 = 0 AND i = 1 THEN 'xx' WHEN n % 5 = 0 THEN 'fr-CA'
                 WHEN n % 5 = 1 THEN 'en-us' ELSE 'en-US' END END AS sntnce_lang_cd,
        CASE WHEN i % 11 <> 10 THEN
            CASE WHEN i % 2 = 0 THEN 'END_USER' ELSE 'AGENT' END END AS sntnce_partcpnt_role,
        ((n + i) % 21 - 10) / CAST(10 AS DOUBLE) AS score,
        CASE WHEN i % 6 <> 5 THEN (i % 5) / CAST(2 AS DOUBLE) END AS magnitude
        FROM (SELECT call_convrstn_id, n, unnest(string_split_regex(text, '[.\n]')) AS s,
              generate_subscripts(string_split_regex(text, '[.\n]'), 1) - 1 AS i FROM cb)""",
    ),
    "sn": (
        ["rs"],
        """SELECT call_convrstn_id, lower(sntnce) AS sntnce, sntnce_ts, sntnce_lang_cd,
        sntnce_partcpnt_role, score, magnitude FROM rs
        WHERE sntnce <> '' AND sntnce <> '\n' AND sntnce_partcpnt_role IS NOT NULL
          AND sntnce_lang_cd IS NOT NULL""",
    ),
    "el_len": (
        ["sn"],
        f"""SELECT call_convrstn_id, count(*) AS cnt_partcpnt FROM (
            SELECT call_convrstn_id, sntnce_partcpnt_role FROM sn
            GROUP BY ALL HAVING count(*) >= {MIN_EXCHANGE})
        GROUP BY 1 HAVING count(*) > 1""",
    ),
    "el_lang": (
        ["sn"],
        f"""SELECT call_convrstn_id, min(sntnce_lang_cd) AS min_lang FROM sn GROUP BY 1
        HAVING count(DISTINCT sntnce_lang_cd) = 1 AND lower(min(sntnce_lang_cd)) = '{ALLOWED_LANG}'""",
    ),
    "es": (
        ["el_len", "el_lang"],
        """SELECT call_convrstn_id, sntnce, sntnce_ts, sntnce_partcpnt_role,
        score * magnitude AS sntnce_sntmnt FROM sn
        WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM el_len)
          AND call_convrstn_id IN (SELECT call_convrstn_id FROM el_lang)""",
    ),
    "routed": (
        ["lab"],
        f"""SELECT call_convrstn_id,
        CASE WHEN label_key IN {_in(fv.VIRTUAL_QUEUE_KEYS)} THEN nullif(label_val, '') END AS virtualqueue,
        CASE WHEN lower(label_key) IN {_in(fv.ACCOUNT_KEYS_LOWER)}
             AND label_val NOT IN ('', '0000000000') THEN label_val END AS ban,
        CASE WHEN label_key = '{fv.AGENT_KEY}' THEN nullif(label_val, '') END AS agnt_id,
        CASE WHEN upper(label_key) IN {_in(fv.TELEPHONE_KEYS_UPPER)} THEN nullif(label_val, '') END AS telephone
        FROM lab""",
    ),
    "attrs": (
        ["routed"],
        """SELECT call_convrstn_id,
        string_agg(DISTINCT virtualqueue, ',' ORDER BY virtualqueue) AS virtualqueues,
        max(ban) AS bus_bacct_num,
        string_agg(DISTINCT agnt_id, ',' ORDER BY agnt_id) AS agnt_id,
        string_agg(DISTINCT telephone, ',' ORDER BY telephone) AS telephone
        FROM routed GROUP BY 1""",
    ),
    "topics": (
        ["iss"],
        "SELECT call_convrstn_id, string_agg(DISTINCT iss_nm, ',' ORDER BY iss_nm) AS topics "
        "FROM iss GROUP BY 1",
    ),
    "convs": (
        ["cb", "attrs", "topics"],
        f"""SELECT call_convrstn_id, call_convrstn_dt AS call_convrstn_date, bus_bacct_num_src_id,
        bus_bacct_num, virtualqueues, agnt_id, telephone, topics,
        {province_sql('telephone')} AS pr_name
        FROM cb JOIN attrs USING (call_convrstn_id) JOIN topics USING (call_convrstn_id)
        WHERE bus_bacct_num IS NOT NULL OR telephone IS NOT NULL""",
    ),
    "v": (
        [],
        f"""SELECT vec_id, vec_id // {CHUNKS_PER_DOC} AS doc_id, label % {N_CHUNKS} AS chunk_idx,
        CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
    ),
    "refs": (
        [],
        """SELECT label AS j, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS pos,
        CAST(arg_max(embedding, vec_id) AS DOUBLE[]) AS neg,
        'i' || CAST(label % 3 AS VARCHAR) AS intent FROM embeddings GROUP BY label""",
    ),
    "pairs": (
        ["v", "refs"],
        """SELECT doc_id, chunk_idx, j, intent, vec_id, list_cosine_distance(vec, pos) AS dp,
        list_cosine_distance(vec, neg) AS dn FROM v, refs""",
    ),
    "scaffold": (
        ["v"],
        f"SELECT DISTINCT doc_id, unnest(range({N_CHUNKS})) AS chunk_idx FROM v",
    ),
}


def with_ctes(names: list[str], body: str) -> str:
    """The body behind the table expressions it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body
