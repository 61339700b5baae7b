"""Queries over filters, predicates, joins and ordered operators (F, J, W, O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.text import clean_tokens
from callsift.operators import calls as C
from callsift.operators import features as X
from callsift.operators import reports as R
from callsift.operators import rules
from callsift.operators.ordering import MIXED_RANGE, global_positions, mixed, number_rows
from callsift.plans import jobs
from catalog import views as V
from catalog.registry import query
from catalog.sources_sinks import _STILL_SQL

ID = C.ID


def _mix(column: str) -> str:
    return f"(({column} * 2654435761) % {MIXED_RANGE})"


# --- filters and predicates --------------------------------------------------------------


@query("f1_sentence_validity", "SELECT call_convrstn_id, sntnce_ts, sntnce_lang_cd, sntnce_partcpnt_role FROM sn", ["sn"])
def f1(spark, d):
    return C.sentences(V.calls(spark, d)).select(ID, "sntnce_ts", "sntnce_lang_cd", "sntnce_partcpnt_role")


@query("f2_label_routing", "SELECT * FROM routed", ["routed"])
def f2(spark, d):
    return C.route_labels(C.explode_labels(V.calls(spark, d)))


@query(
    "f3_sentinels_to_null",
    "SELECT count(*) AS n, count(virtualqueue) AS vq, count(ban) AS ban, count(agnt_id) AS agnt, "
    "count(telephone) AS tel FROM routed",
    ["routed"],
)
def f3(spark, d):
    return C.route_labels(C.explode_labels(V.calls(spark, d))).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("virtualqueue").alias("vq"),
        F.count("ban").alias("ban"),
        F.count("agnt_id").alias("agnt"),
        F.count("telephone").alias("tel"),
    )


@query(
    "f4_known_identity",
    "SELECT * FROM attrs WHERE bus_bacct_num IS NOT NULL OR telephone IS NOT NULL",
    ["attrs"],
)
def f4(spark, d):
    return C.known_identity(C.label_attributes(V.calls(spark, d)))


@query(
    "f5_sentiment",
    "SELECT call_convrstn_id, sntnce_ts, round(score * magnitude, 6) AS sntnce_sntmnt FROM sn",
    ["sn"],
)
def f5(spark, d):
    return C.sentences(V.calls(spark, d)).select(
        ID,
        "sntnce_ts",
        F.round(C.sentiment(F.col("sntnce_sntmnt_scor_qty"), F.col("sntnce_sntmnt_mgntd_qty")), 6).alias("sntnce_sntmnt"),
    )


@query("f6_lower_text", "SELECT call_convrstn_id, sntnce_ts, sntnce FROM sn", ["sn"])
def f6(spark, d):
    return C.sentences(V.calls(spark, d)).select(ID, "sntnce_ts", "sntnce")


@query(
    "f7_province",
    f"SELECT call_convrstn_id, telephone, {V.province_sql('telephone')} AS pr_name FROM facts",
    ["facts"],
)
def f7(spark, d):
    return C.with_province(V.conversation_facts(spark, d)).select(ID, "telephone", "pr_name")


@query("f8_customer_rows", "SELECT * FROM u WHERE sntnce_partcpnt_role = 'END_USER'", ["u"])
def f8(spark, d):
    return V.utterances(spark, d).filter(rules.is_customer(F.col("sntnce_partcpnt_role")))


@query("f9_naive_rule", f"SELECT * FROM u WHERE {V.NAIVE_SQL}", ["u"])
def f9(spark, d):
    return rules.naive_matches(V.utterances(spark, d))


_FLAGGED = f"""SELECT *, {V.MOVER_SQL} AS mover, {V.EXCLUDED_SQL} AS excluded,
    coalesce(lead({V.CANCEL_SQL}, 3) OVER w, FALSE) AS after3,
    coalesce(lag({V.CANCEL_SQL}, 3) OVER w, FALSE) AS before3
    FROM un WINDOW w AS (PARTITION BY call_convrstn_id ORDER BY sntnce_ts)"""
_SELECTED = "SELECT * FROM flagged WHERE mover AND NOT excluded AND NOT after3"
_REMOVED = "SELECT DISTINCT call_convrstn_id FROM flagged WHERE mover AND after3"


def _slim(spark, d):
    return number_rows(rules.slim_sentences(V.utterances(spark, d)), ID, ["sntnce_ts"])


@query(
    "f10_preselection",
    f"""SELECT call_convrstn_id, chunk_id, sntnce, 'selected' AS outcome FROM ({_SELECTED.replace('flagged', f'({_FLAGGED})')})
    UNION ALL SELECT call_convrstn_id, -1, '', 'removed' FROM ({_REMOVED.replace('flagged', f'({_FLAGGED})')})""",
    ["un"],
)
def f10(spark, d):
    selected, removed = rules.preselect(_slim(spark, d))
    return selected.select(ID, "chunk_id", "sntnce", F.lit("selected").alias("outcome")).union(
        removed.select(ID, F.lit(-1), F.lit(""), F.lit("removed"))
    )


@query(
    "f11_score_threshold",
    "SELECT vec_id, detection_score FROM (SELECT vec_id, (vec_id % 101) / CAST(100 AS DOUBLE) "
    "AS detection_score FROM embeddings) WHERE detection_score > 0.5",
)
def f11(spark, d):
    scored = V.table(spark, d, "embeddings").select(
        "vec_id", ((F.col("vec_id") % 101) / 100.0).alias("detection_score")
    )
    return rules.above_threshold(scored)


@query(
    "f12_non_empty_chunks",
    f"SELECT * FROM (SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un "
    "WHERE sntnce_partcpnt_role = 'END_USER') WHERE text <> ''",
    ["un"],
)
def f12(spark, d):
    return rules.non_empty(X.customer_chunks(V.numbered(spark, d)), "text")


@query(
    "f13_any_family",
    f"SELECT * FROM u WHERE {V.any_sql('sntnce', [p for ps in fv.PATTERNS.values() for p in ps])}",
    ["u"],
)
def f13(spark, d):
    return rules.any_family(V.utterances(spark, d))


def _annotations(spark, d):
    """Utterances as annotated rows; ids repeat and some labels are missing."""
    turns = V.table(spark, d, "conversations")
    n, t = F.col("conv_id"), F.col("turn")
    return turns.select(
        n.cast("string").alias("conv_id"),
        F.floor(t / 2).alias("chunk_id"),
        F.lower("text").alias("sntnce"),
        F.when((n + t) % 5 == 0, None).when((n + t) % 3 == 0, "N").otherwise("Y").alias("label"),
        t.alias("row_ord"),
    )


_ANNOT_SQL = """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn // 2 AS VARCHAR) AS chunk_id,
    lower(text) AS sntnce, CASE WHEN (conv_id + turn) % 3 = 0 THEN 0 ELSE 1 END AS label, turn
    FROM conversations WHERE (conv_id + turn) % 5 <> 0"""


@query(
    "f14_annotations",
    f"""SELECT conv_id, chunk_id, arg_max(label, turn) AS label, count(*) AS sentences
        FROM ({_ANNOT_SQL}) GROUP BY ALL""",
)
def f14(spark, d):
    said, labels = X.clean_annotations(_annotations(spark, d), "row_ord")
    counts = said.groupBy(F.col(ID).alias("conv_id"), "chunk_id").agg(
        F.count(F.lit(1)).alias("sentences")
    )
    return labels.join(counts, ["conv_id", "chunk_id"])


SIZING_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS call_convrstn_id, {V.province_sql('phone')} AS pr_name,
    CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 101) / CAST(100 AS DOUBLE) END AS iss_max,
    CASE WHEN c_custkey % 4 <> 0 THEN phone END AS num
    FROM (SELECT c_custkey, ({V.sql_list(V.AREAS)})[c_custkey % {len(V.AREAS)} + 1] || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone FROM customer)"""


def sizing_input(spark, d):
    n = F.col("c_custkey")
    phone = F.concat(V.pick(V.AREAS, n % len(V.AREAS)), F.lpad(n.cast("string"), 7, "0"))
    return V.table(spark, d, "customer").select(
        n.cast("string").alias(ID),
        C.province(phone).alias("pr_name"),
        F.when(n % 13 != 0, (n % 101) / 100.0).alias("iss_max"),
        F.when(n % 4 != 0, phone).alias("num"),
    )


@query(
    "f15_issue_and_identity",
    f"""SELECT pr_name, count(*) FILTER (WHERE iss_max > 0.75) AS high, count(num) AS identified
        FROM ({SIZING_SQL}) GROUP BY 1""",
)
def f15(spark, d):
    return sizing_input(spark, d).groupBy("pr_name").agg(
        F.count_if(R.high_issue(F.col("iss_max"))).alias("high"),
        F.count_if(R.identified(F.col("num"))).alias("identified"),
    )


@query(
    "f16_column_pick",
    "SELECT bus_bacct_num, bus_bacct_num_src_id, telephone, call_convrstn_id, "
    "CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date FROM facts",
    ["facts"],
)
def f16(spark, d):
    columns = [c["name"] for c in fv.OTHER_ID_COLUMNS] + [ID, "call_convrstn_date"]
    return C.pick(V.conversation_facts(spark, d), columns).withColumn(
        "call_convrstn_date", F.col("call_convrstn_date").cast("string")
    )


# --- joins ---------------------------------------------------------------------------------


@query("j1_unnest_labels", "SELECT * FROM lab", ["lab"])
def j1(spark, d):
    return C.explode_labels(V.calls(spark, d))


@query("j2_unnest_issues", "SELECT * FROM iss", ["iss"])
def j2(spark, d):
    return V.calls(spark, d).select(ID, F.inline("convrstn_iss"))


@query(
    "j3_unnest_sentences",
    "SELECT call_convrstn_id, count(*) AS n, count(sntnce) AS said FROM sn GROUP BY 1",
    ["sn"],
)
def j3(spark, d):
    return C.sentences(V.calls(spark, d)).groupBy(ID).agg(
        F.count(F.lit(1)).alias("n"), F.count("sntnce").alias("said")
    )


_CONV_COLUMNS = (
    "call_convrstn_id, CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date, bus_bacct_num_src_id, "
    "bus_bacct_num, virtualqueues, agnt_id, telephone, topics"
)


@query("j4_conversations", f"SELECT {_CONV_COLUMNS} FROM convs", ["convs"])
def j4(spark, d):
    return C.conversations(V.calls(spark, d)).withColumn(
        "call_convrstn_date", F.col("call_convrstn_date").cast("string")
    )


@query(
    "j5_eligible_sentences",
    "SELECT call_convrstn_id, sntnce, sntnce_ts, sntnce_partcpnt_role, round(sntnce_sntmnt, 6) AS sntnce_sntmnt FROM es",
    ["es"],
)
def j5(spark, d):
    said = C.sentences(V.calls(spark, d))
    ids = C.eligible_ids(said, V.MIN_EXCHANGE, V.ALLOWED_LANG)
    return C.eligible_sentences(said, ids).withColumn("sntnce_sntmnt", F.round("sntnce_sntmnt", 6))


@query(
    "j6_mutual_eligibility",
    """SELECT 'conversations' AS side, call_convrstn_id, count(*) AS n FROM convs
       WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM es) GROUP BY ALL
       UNION ALL SELECT 'sentences', call_convrstn_id, count(*) FROM es
       WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM convs) GROUP BY ALL""",
    ["convs", "es"],
)
def j6(spark, d):
    calls = V.calls(spark, d)
    said = C.sentences(calls)
    ids = C.eligible_ids(said, V.MIN_EXCHANGE, V.ALLOWED_LANG)
    convs, said = C.with_both(C.conversations(calls), C.eligible_sentences(said, ids))
    parts = [
        R.row_count(df.groupBy(F.lit(side).alias("side"), ID))
        for side, df in (("conversations", convs), ("sentences", said))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "j7_detections_with_facts",
    f"""SELECT call_convrstn_id AS conv_id, 1.0::DOUBLE AS detection_score, bus_bacct_num, bus_bacct_num_src_id,
        telephone, CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date
        FROM (SELECT DISTINCT call_convrstn_id FROM u WHERE {V.NAIVE_SQL}) LEFT JOIN facts USING (call_convrstn_id)""",
    ["u", "facts"],
)
def j7(spark, d):
    found = jobs.with_facts(jobs.detect_naive(V.utterances(spark, d)), V.conversation_facts(spark, d))
    return found.withColumn("call_convrstn_date", F.col("call_convrstn_date").cast("string"))


@query(
    "j8_without_removed",
    f"SELECT call_convrstn_id, chunk_id, sntnce FROM ({_SELECTED.replace('flagged', f'({_FLAGGED})')}) "
    f"WHERE call_convrstn_id NOT IN ({_REMOVED.replace('flagged', f'({_FLAGGED})')})",
    ["un"],
)
def j8(spark, d):
    selected, removed = rules.preselect(_slim(spark, d))
    return rules.without(selected, removed).select(ID, "chunk_id", "sntnce")


@query(
    "j9_without_early_cancel",
    f"""SELECT * FROM u WHERE {V.NAIVE_SQL} AND call_convrstn_id NOT IN
        (SELECT call_convrstn_id FROM un WHERE chunk_id < 3 AND {V.CANCEL_SQL})""",
    ["un"],
)
def j9(spark, d):
    said = V.utterances(spark, d)
    early = rules.early_cancellations(said, 3)
    return rules.without(rules.naive_matches(said), early)


def _report_sql():
    columns = ", ".join(
        f"{V.join_sql(V.matches_sql('sntnce', fv.PATTERNS[f]), ';')} AS {n}"
        for f, n in R.REPORT_FAMILIES.items()
    )
    return f"SELECT call_convrstn_id, chunk_id, sntnce AS text, {columns} FROM un WHERE {V.MOVER_SQL}"


REPORT_SQL = _report_sql()


@query(
    "j10_matches_with_facts",
    f"""SELECT call_convrstn_id, chunk_id, mover_match, bus_bacct_num, CAST(call_convrstn_date AS VARCHAR) AS day
        FROM ({REPORT_SQL}) LEFT JOIN facts USING (call_convrstn_id)""",
    ["un", "facts"],
)
def j10(spark, d):
    found = R.with_call_facts(R.match_report(V.numbered(spark, d)), V.conversation_facts(spark, d))
    return found.select(
        ID, "chunk_id", "mover_match", "bus_bacct_num", F.col("call_convrstn_date").cast("string").alias("day")
    )


@query(
    "j12_chunk_labels",
    f"""SELECT un.call_convrstn_id, un.chunk_id, a.label FROM un JOIN
        (SELECT conv_id, chunk_id, arg_max(label, turn) AS label FROM ({_ANNOT_SQL}) GROUP BY ALL) a
        ON a.conv_id = un.call_convrstn_id AND a.chunk_id = CAST(un.chunk_id AS VARCHAR)""",
    ["un"],
)
def j12(spark, d):
    _, labels = X.clean_annotations(_annotations(spark, d), "row_ord")
    return X.attach_labels(V.numbered(spark, d), labels).select(ID, "chunk_id", "label")


@query(
    "j14_membership",
    f"SELECT call_convrstn_id, call_convrstn_id IN (SELECT CAST(conv_id AS VARCHAR) FROM conversations) AS known FROM ({SIZING_SQL})",
)
def j14(spark, d):
    return R.flag_known(sizing_input(spark, d), V.utterances(spark, d)).select(ID, "known")


# --- ordered operators -----------------------------------------------------------------------


@query("w1_chunk_ids", "SELECT call_convrstn_id, sntnce_ts, chunk_id FROM un", ["un"])
def w1(spark, d):
    return V.numbered(spark, d).select(ID, "sntnce_ts", "chunk_id")


@query(
    "w1_chunk_ids_global",
    "SELECT call_convrstn_id, sntnce_ts, row_number() OVER (ORDER BY call_convrstn_id, sntnce_ts) - 1 AS chunk_id FROM u",
    ["u"],
)
def w1_global(spark, d):
    """Numbers over all conversations, from a range-partitioned sort."""
    said = V.utterances(spark, d).select(ID, "sntnce_ts")
    return global_positions(said, [ID, "sntnce_ts"], "chunk_id")


@query(
    "w1_chunk_ids_large_keys",
    "SELECT call_convrstn_id, sntnce_ts, row_number() OVER (PARTITION BY call_convrstn_id ORDER BY sntnce_ts) - 1 AS chunk_id FROM sn",
    ["sn"],
)
def w1_large(spark, d):
    """The plan for conversations that are too long for one task."""
    said = C.sentences(V.calls(spark, d)).select(ID, "sntnce_ts")
    return number_rows(said, ID, ["sntnce_ts"], large_keys=True)


@query(
    "w1_repeated_times",
    """SELECT call_convrstn_id, ts, sntnce_partcpnt_role AS role, sntnce,
        row_number() OVER (PARTITION BY call_convrstn_id ORDER BY ts, sntnce_partcpnt_role, sntnce) - 1 AS chunk_id
        FROM (SELECT *, sntnce_ts // 3 AS ts FROM u)""",
    ["u"],
)
def w1_ties(spark, d):
    """Several sentences of one time: their order is that of the columns named after it."""
    said = V.utterances(spark, d).select(
        ID, F.floor(F.col("sntnce_ts") / 3).alias("ts"), F.col("sntnce_partcpnt_role").alias("role"), "sntnce"
    )
    return number_rows(said, ID, ["ts", "role", "sntnce"])


@query(
    "w1_spoken_order",
    """SELECT call_convrstn_id, ts, i::INTEGER AS sntnce_place, sntnce_ts, row_number() OVER
        (PARTITION BY call_convrstn_id ORDER BY ts, i, sntnce_ts) - 1 AS chunk_id
        FROM (SELECT *, sntnce_ts // 20000 AS ts FROM rs WHERE sntnce <> '' AND sntnce <> '\n'
              AND sntnce_partcpnt_role IS NOT NULL AND sntnce_lang_cd IS NOT NULL)""",
    ["rs"],
)
def w1_spoken(spark, d):
    """Sentences of one time are numbered in their order in the nested record."""
    said = C.sentences(V.calls(spark, d), (*C.SAID_WHEN, C.PLACE))
    coarse = said.select(ID, F.floor(F.col("sntnce_ts") / 20000).alias("ts"), C.PLACE, "sntnce_ts")
    return number_rows(coarse, ID, ["ts", C.PLACE, "sntnce_ts"])


@query(
    "w2_neighbour_context",
    f"""SELECT call_convrstn_id, chunk_id, after3, before3 FROM ({_FLAGGED}) WHERE after3 OR before3""",
    ["un"],
)
def w2(spark, d):
    """Rows with a cancellation three sentences later, earlier, or both."""
    slim = _slim(spark, d)
    after = rules.neighbours_cancelling(slim, 3).withColumn("after3", F.lit(True))
    before = rules.neighbours_cancelling(slim, -3).withColumn("before3", F.lit(True))
    near = after.join(before, [ID, "chunk_id"], "full").na.fill(False)
    return slim.select(ID, "chunk_id").join(near, [ID, "chunk_id"])


@query(
    "w3_early_cancellations",
    f"""SELECT DISTINCT call_convrstn_id FROM (SELECT *, row_number() OVER
        (PARTITION BY call_convrstn_id ORDER BY sntnce_ts) AS r FROM sn) WHERE r <= 10 AND {V.CANCEL_SQL}""",
    ["sn"],
)
def w3(spark, d):
    return rules.early_cancellations(C.sentences(V.calls(spark, d)))


_CLEAN_TOKENS_SQL = r"""list_filter(regexp_extract_all(regexp_replace(lower(sntnce), '(\-|\_|\.|\/|\\|\:|\;|\,|\n|\[|\])', ' ', 'g'), '([a-z'']+)', 0),
    lambda t: length(t) > 1 AND NOT list_contains(['the','and','of','und','la','que','der','is'], t))"""


def _first_line(spark, d, reverse):
    said = V.utterances(spark, d).withColumn(
        "line", clean_tokens(F.lower("sntnce"), V.PROSE_STOPWORDS)
    )
    found = rules.first_clean_line(said, ID, "sntnce_ts", "line", reverse)
    return found.select(ID, F.array_join("tokens", "|").alias("tokens"))


@query(
    "w4_first_clean_line",
    f"""SELECT call_convrstn_id, coalesce(arg_min(t, sntnce_ts) FILTER (WHERE t <> ''), '') AS tokens
        FROM (SELECT *, {V.join_sql(_CLEAN_TOKENS_SQL)} AS t FROM u) GROUP BY 1""",
    ["u"],
)
def w4(spark, d):
    return _first_line(spark, d, False)


@query(
    "w4_last_clean_line",
    f"""SELECT call_convrstn_id, coalesce(arg_max(t, sntnce_ts) FILTER (WHERE t <> ''), '') AS tokens
        FROM (SELECT *, {V.join_sql(_CLEAN_TOKENS_SQL)} AS t FROM u) GROUP BY 1""",
    ["u"],
)
def w4_reverse(spark, d):
    return _first_line(spark, d, True)


@query(
    "w5_balanced_sample",
    f"""SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER
        (PARTITION BY quality ORDER BY {_mix('doc_id')}, doc_id) AS r FROM labels)
        WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))""",
)
def w5(spark, d):
    labels = V.table(spark, d, "labels").select("doc_id", "quality")
    return rules.balanced(labels, "quality", mixed(F.col("doc_id")), MIXED_RANGE, ["doc_id"])


@query(
    "w6_sampled_conversations",
    f"""SELECT call_convrstn_id, chunk_id, text FROM ({_STILL_SQL}) WHERE call_convrstn_id IN (
        SELECT call_convrstn_id FROM (SELECT DISTINCT call_convrstn_id FROM ({_STILL_SQL}))
        ORDER BY {_mix('CAST(call_convrstn_id AS BIGINT)')}, call_convrstn_id LIMIT 40)""",
    ["un"],
)
def w6(spark, d):
    matches = jobs.label_matches(V.utterances(spark, d))
    return rules.sample_conversations(matches, 40, mixed(F.col(ID)))


def _split_sql(ratio: float) -> str:
    return f"""SELECT doc_id, CASE WHEN r <= ceil(n * CAST({ratio} AS DOUBLE)) THEN 'test' ELSE 'train' END AS part
        FROM (SELECT doc_id, row_number() OVER (ORDER BY {_mix('doc_id')}, doc_id) AS r,
        count(*) OVER () AS n FROM documents)"""


def _split(spark, d, ratio):
    docs = V.table(spark, d, "documents").select("doc_id")
    train, test = X.split_rows(docs, ratio, mixed(F.col("doc_id")), MIXED_RANGE, ["doc_id"])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("w7_split_text", _split_sql(0.3))
def w7_text(spark, d):
    return _split(spark, d, fv.TEST_RATIO_TEXT)


@query("w7_split_features", _split_sql(0.15))
def w7_features(spark, d):
    return _split(spark, d, fv.TEST_RATIO_FEATURES)


@query(
    "w7_split_by_conversation",
    f"""SELECT call_convrstn_id, sntnce_ts, CASE WHEN r <= ceil(n * CAST(0.15 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part
        FROM u JOIN (SELECT call_convrstn_id, count(*) OVER () AS n, row_number() OVER (ORDER BY
        {_mix('CAST(call_convrstn_id AS BIGINT)')}, call_convrstn_id) AS r
        FROM (SELECT DISTINCT call_convrstn_id FROM u)) USING (call_convrstn_id)""",
    ["u"],
)
def w7_conversations(spark, d):
    said = V.utterances(spark, d).select(ID, "sntnce_ts")
    train, test = X.split_conversations(said, 0.15, mixed(F.col(ID)), MIXED_RANGE, ID)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


# --- sorts, limits, sets ------------------------------------------------------------------------


@query("o1_sorted_sentences", "SELECT * FROM u ORDER BY call_convrstn_id, sntnce_ts", ["u"])
def o1(spark, d):
    return V.utterances(spark, d).orderBy(ID, "sntnce_ts")


@query(
    "o2_smallest_counts",
    "SELECT call_convrstn_id, count(sntnce) AS sntnce FROM u GROUP BY 1 ORDER BY 2, 1 LIMIT 5",
    ["u"],
)
def o2(spark, d):
    return R.least(R.sentence_counts(V.utterances(spark, d)), ["sntnce", ID], 5)


@query(
    "o3_union_of_days",
    f"""SELECT call_convrstn_id AS conv_id, 1.0::DOUBLE AS detection_score FROM u WHERE {V.NAIVE_SQL} GROUP BY 1
        UNION ALL SELECT call_convrstn_id, 1.0::DOUBLE FROM sn WHERE {V.NAIVE_SQL} GROUP BY 1""",
    ["u", "sn"],
)
def o3(spark, d):
    return jobs.union_days(
        [
            jobs.detect_naive(V.utterances(spark, d)),
            jobs.detect_naive(C.sentences(V.calls(spark, d))),
        ]
    )


@query(
    "o4_distinct_matches",
    f"""SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct({V.matches_sql('text', V.PROSE_PATTERNS)})), '|'), '') AS found
        FROM documents""",
)
def o4(spark, d):
    from callsift.functions.regex import all_matches

    docs = V.table(spark, d, "documents")
    found = F.array_sort(F.array_distinct(all_matches(F.col("text"), V.PROSE_PATTERNS)))
    return docs.select("doc_id", F.array_join(found, "|").alias("found"))


@query("o5_conversation_ids", "SELECT DISTINCT call_convrstn_id FROM u", ["u"])
def o5(spark, d):
    return V.utterances(spark, d).select(ID).distinct()

