"""Queries over text, array and vocabulary functions."""

from __future__ import annotations

import string

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions import regex as RX
from callsift.functions import text as TX
from callsift.operators import features as X
from callsift.operators import lexicon as LX
from callsift.operators import reports as R
from callsift.operators import token_blocks as TB
from callsift.operators import word_vectors as WV
from callsift.operators.calls import ID
from callsift.session import stage
from catalog import views as V
from catalog.filters_joins import REPORT_SQL
from catalog.registry import query

# a small dictionary over words that occur
FORMS = {"the": "a", "und": "and", "la": "le", "of": "from", "is": "be", "was": "be"}


def docs(spark, d):
    return V.table(spark, d, "documents").select("doc_id", "text")


def bar(column):
    return F.array_join(column, "|")


@query(
    "t1_any_pattern",
    "SELECT call_convrstn_id, sntnce_ts, "
    + ", ".join(f"{V.any_sql('sntnce', ps)} AS {f}" for f, ps in fv.PATTERNS.items())
    + " FROM u",
    ["u"],
)
def t1(spark, d):
    return V.utterances(spark, d).select(
        ID,
        "sntnce_ts",
        *[RX.any_match(F.col("sntnce"), ps).alias(f) for f, ps in fv.PATTERNS.items()],
    )


@query(
    "t2_all_matches",
    f"SELECT doc_id, {V.join_sql(V.matches_sql('text', V.PROSE_PATTERNS))} AS found FROM documents",
)
def t2(spark, d):
    return docs(spark, d).select(
        "doc_id", bar(RX.all_matches(F.col("text"), V.PROSE_PATTERNS)).alias("found")
    )


@query(
    "t3_pattern_indexes",
    "SELECT doc_id, concat_ws('|', "
    + ", ".join(
        f"CASE WHEN regexp_matches(text, {V.sql_text(p)}) THEN '{i}' END"
        for i, p in enumerate(V.PROSE_PATTERNS)
    )
    + ") AS found FROM documents",
)
def t3(spark, d):
    return docs(spark, d).select(
        "doc_id", bar(RX.matching_indexes(F.col("text"), V.PROSE_PATTERNS).cast("array<string>")).alias("found")
    )


def _starts(text, patterns):
    return "flatten([" + ", ".join(V.starts_sql(text, p) for p in patterns) + "])"


@query(
    "t4_match_starts",
    f"SELECT doc_id, {V.join_sql(_starts('text', V.PROSE_PATTERNS))} AS starts, "
    f"{V.join_sql(V.matches_sql('text', V.PROSE_PATTERNS))} AS found FROM documents",
)
def t4(spark, d):
    spans = docs(spark, d).withColumn("spans", RX.all_spans(F.col("text"), V.PROSE_PATTERNS))
    return spans.select(
        "doc_id",
        bar(F.col("spans.start").cast("array<string>")).alias("starts"),
        bar(F.col("spans.match")).alias("found"),
    )


_KEYWORD_PATTERNS = [RX.keyword_pattern(k) for k in V.PROSE_KEYWORDS]


@query(
    "t5_keywords",
    f"""SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list_transform(
        {V.matches_sql('text', _KEYWORD_PATTERNS)}, lambda m: {V.strip_sql('m')}))), '|'), '') AS found FROM documents""",
)
def t5(spark, d):
    return docs(spark, d).select(
        "doc_id", bar(RX.keyword_matches(F.col("text"), V.PROSE_KEYWORDS)).alias("found")
    )


@query(
    "t6_keyword_starts",
    f"SELECT doc_id, {V.join_sql(_starts('text', _KEYWORD_PATTERNS))} AS starts, "
    f"{V.join_sql(V.matches_sql('text', _KEYWORD_PATTERNS))} AS found FROM documents",
)
def t6(spark, d):
    spans = docs(spark, d).withColumn("spans", RX.keyword_spans(F.col("text"), V.PROSE_KEYWORDS))
    return spans.select(
        "doc_id",
        bar(F.col("spans.start").cast("array<string>")).alias("starts"),
        bar(F.col("spans.match")).alias("found"),
    )


@query(
    "t7_remove_tokens",
    f"SELECT doc_id, {V.clean_sql('text')} AS text FROM documents",
)
def t7(spark, d):
    return docs(spark, d).select("doc_id", X.cleaned(F.col("text")).alias("text"))


_STOP_SQL = V.sql_list(V.PROSE_STOPWORDS)
_TAG_BODY = "(" + "|".join(fv.TAGS) + ")"


@query(
    "t8_clean_tokens",
    rf"""SELECT doc_id, {V.join_sql(
        rf"list_filter(regexp_extract_all(regexp_replace(lower(regexp_replace(text, {V.sql_text(_TAG_BODY)}, '', 'g')), "
        rf"'(\-|\_|\.|\/|\\|\:|\;|\,|\n|\[|\])', ' ', 'g'), '([a-z'']+)', 0), "
        rf"lambda t: length(t) > 1 AND NOT list_contains({_STOP_SQL}, t))")} AS tokens FROM documents""",
)
def t8(spark, d):
    return docs(spark, d).select(
        "doc_id", bar(TX.clean_tokens(F.col("text"), V.PROSE_STOPWORDS, fv.TAGS)).alias("tokens")
    )


_NORMAL_SQL = (
    rf"list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+'), "
    rf"lambda t: length(t) > 0 AND NOT list_contains({_STOP_SQL}, t))"
)


@query(
    "t9_training_text",
    f"SELECT doc_id, {V.join_sql(_NORMAL_SQL, ' ')} AS text_clean FROM documents",
)
def t9(spark, d):
    out = X.training_text(docs(spark, d), "text", V.PROSE_STOPWORDS, fv.TAGS)
    return out.select("doc_id", "text_clean")


_LEMMA_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORMS.items())
_LEMMA_SQL = (
    r"SELECT doc_id, "
    + V.join_sql(
        r"list_transform(list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+'), "
        r"lambda t: length(t) > 0), lambda t: CASE t " + _LEMMA_CASES + " ELSE t END)",
        " ",
    )
    + " AS text_clean FROM documents"
)


@query("t10_lemmas", _LEMMA_SQL)
def t10(spark, d):
    out = X.training_text(docs(spark, d), "text", [], None, FORMS)
    return out.select("doc_id", "text_clean")


@query("t10_lemmas_by_join", _LEMMA_SQL)
def t10_join(spark, d):
    """The plan for a dictionary too large for a constant."""
    table = spark.createDataFrame(sorted(FORMS.items()), "form string, lemma string")
    tokens = docs(spark, d).select("doc_id", TX.training_tokens(F.col("text")).alias("tokens"))
    out = LX.replace_words_by_join(tokens, "doc_id", "tokens", table)
    return out.select("doc_id", F.array_join("tokens", " ").alias("text_clean"))


@query(
    "t9_large_dictionary",
    r"SELECT doc_id, "
    + V.join_sql(
        r"list_transform(list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+'), "
        r"lambda t: length(t) > 0), lambda t: left(t, 3))",
        " ",
    )
    + " AS text_clean FROM documents",
)
def t9_dictionary(spark, d):
    """Every word of all documents is an entry of the dictionary."""
    rows = docs(spark, d)
    words = TB.distinct_words(rows.select(TX.training_tokens(F.col("text")).alias("tokens")), "tokens")
    forms = words.select(F.col("_word").alias("form"), F.substring("_word", 1, 3).alias("lemma"))
    return X.training_text(rows, "text", [], None, forms, "doc_id").select("doc_id", "text_clean")


@query(
    "t11_word_grams",
    r"SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda w: length(w) > 0) AS w, 0 AS x FROM documents".join(
        [
            "SELECT doc_id, coalesce(array_to_string(w, '|'), '') AS grams, "
            "coalesce(array_to_string(list_transform(range(1, len(w) + 1), lambda i: array_to_string(w[i:i + 1], ' ')), '|'), '') AS pairs FROM (",
            ")",
        ]
    ),
)
def t11(spark, d):
    return docs(spark, d).select(
        "doc_id",
        bar(TX.word_grams(F.col("text"))).alias("grams"),
        bar(TX.word_grams(F.col("text"), 2)).alias("pairs"),
    )


@query(
    "t12_normalise",
    "SELECT doc_id, translate(lower(text), " + V.sql_text(string.punctuation) + ", '') AS text FROM documents",
)
def t12(spark, d):
    return docs(spark, d).select("doc_id", TX.normalise(F.col("text")).alias("text"))


@query(
    "t13_sub_sentences",
    rf"""SELECT doc_id, {V.join_sql(rf"list_filter(string_split_regex(text, '(?:\.|\;|\,)'), lambda s: length(s) > 5)")} AS parts FROM documents""",
)
def t13(spark, d):
    return docs(spark, d).select("doc_id", bar(TX.sub_sentences(F.col("text"))).alias("parts"))


@query(
    "t14_customer_chunks",
    f"SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un WHERE sntnce_partcpnt_role = 'END_USER'",
    ["un"],
)
def t14(spark, d):
    return X.customer_chunks(V.numbered(spark, d))


def relpos_sql(text: str, patterns: list[str]) -> str:
    starts = _starts(text, patterns)
    return (
        f"CASE WHEN len({starts}) > 0 THEN list_sum({starts}) / "
        f"(CAST(length({text}) AS DOUBLE) * len({starts})) ELSE -1.0 END"
    )


@query(
    "t15_relative_position",
    f"""SELECT call_convrstn_id, chunk_id, length(text) AS sntce_len, round({relpos_sql('text', fv.PATTERNS['movers'])}, 6) AS rel_pos_sntce
        FROM (SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un WHERE sntnce_partcpnt_role = 'END_USER')
        WHERE text <> ''""",
    ["un"],
)
def t15(spark, d):
    chunks = X.customer_chunks(V.numbered(spark, d)).filter(F.length("text") > 0)
    return chunks.select(
        ID,
        "chunk_id",
        F.length("text").alias("sntce_len"),
        F.round(X.relative_position(F.col("text")), 6).alias("rel_pos_sntce"),
    )


@query(
    "t15_relative_position_prose",
    f"SELECT doc_id, round({relpos_sql('text', V.PROSE_PATTERNS)}, 6) AS rel_pos FROM documents",
)
def t15_prose(spark, d):
    return docs(spark, d).select(
        "doc_id", F.round(X.relative_position(F.col("text"), V.PROSE_PATTERNS), 6).alias("rel_pos")
    )


@query("t16_match_report", REPORT_SQL, ["un"])
def t16(spark, d):
    return R.match_report(V.numbered(spark, d))


@query(
    "t17_ansi_marks",
    "SELECT doc_id, text FROM documents",
)
def t17(spark, d):
    marked = docs(spark, d).withColumn(
        "text", F.concat(F.lit("\x1b[1m"), "text", F.lit("\x1b[0m"))
    )
    return marked.withColumn("text", TX.without_ansi_marks(F.col("text")))


_TOKENS_SQL = (
    "SELECT doc_id, list_filter(string_split(translate(lower(text), "
    + V.sql_text(fv.TOKENIZER_FILTERS)
    + ", "
    + V.sql_text(" " * len(fv.TOKENIZER_FILTERS))
    + "), ' '), lambda t: length(t) > 0) AS tokens FROM documents"
)
_VOCAB_SQL = f"""SELECT token, n, row_number() OVER (ORDER BY n DESC, doc_id, pos) + 1 AS id FROM (
    SELECT token, count(*) AS n, min(doc_id) AS doc_id, arg_min(pos, (doc_id, pos)) AS pos FROM (
        SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM ({_TOKENS_SQL})) GROUP BY token)"""


def tokens(spark, d):
    return docs(spark, d).select("doc_id", TX.corpus_tokens(F.col("text")).alias("tokens"))


@query("t18_vocabulary", _VOCAB_SQL)
def t18(spark, d):
    return LX.vocabulary(tokens(spark, d), "doc_id", "tokens").withColumnRenamed("count", "n")


@query(
    "t19_padded_ids",
    f"""WITH v AS ({_VOCAB_SQL}), t AS ({_TOKENS_SQL}),
    x AS (SELECT doc_id, unnest(tokens[1:15]) AS token, generate_subscripts(tokens[1:15], 1) AS pos FROM t),
    y AS (SELECT doc_id, list(CASE WHEN v.n >= 3 THEN v.id ELSE 1 END ORDER BY pos) AS ids FROM x JOIN v USING (token) GROUP BY doc_id)
    SELECT t.doc_id, array_to_string(list_concat(coalesce(ids, []), list_transform(range(15 - len(coalesce(ids, []))), lambda i: 0)), '|') AS ids
    FROM t LEFT JOIN y USING (doc_id)""",
)
def t19(spark, d):
    """Rare words are left out of the vocabulary, so that unknown words occur."""
    rows = tokens(spark, d)
    vocab = LX.vocabulary(rows, "doc_id", "tokens").filter(F.col("count") >= 3)
    ids = LX.padded_ids(rows, "doc_id", "tokens", vocab)
    return ids.select("doc_id", bar(F.col("ids").cast("array<string>")).alias("ids"))


@query(
    "j13_embedding_rows",
    f"""WITH v AS ({_VOCAB_SQL}), w AS (SELECT vec_id + 2 AS id, embedding FROM embeddings)
    SELECT v.id, v.token, round(coalesce(CAST(embedding[1] AS DOUBLE), 0.0), 6) AS first, coalesce(len(embedding), 64) AS width
    FROM v LEFT JOIN w ON v.id = w.id
    UNION ALL SELECT 0, NULL, 0.0, 64 UNION ALL SELECT 1, '[UNK]', 0.0, 64""",
)
def j13(spark, d):
    """The embeddings serve as vectors of the most frequent words."""
    vocab = LX.vocabulary(tokens(spark, d), "doc_id", "tokens")
    vectors = (
        V.table(spark, d, "embeddings")
        .join(vocab, F.col("vec_id") + 2 == F.col("id"))
        .select(F.col("token").alias("word"), F.col("embedding").cast("array<double>").alias("vector"))
    )
    rows = LX.embedding_rows(vocab, vectors, 64)
    return rows.select(
        "id", "token", F.round(F.col("vector")[0], 6).alias("first"), F.size("vector").alias("width")
    )


@query(
    "m10_word_vectors",
    """SELECT word, 200 AS width FROM (SELECT DISTINCT unnest(string_split_regex(sntnce, '\\s+')) AS word FROM u) WHERE word <> ''""",
    ["u"],
)
def m10(spark, d):
    """Every word has a vector of the stated width."""
    said = V.utterances(spark, d).select(TX.words_of(F.col("sntnce")).alias("tokens"))
    vectors = LX.fit_word_vectors(said, "tokens").getVectors()
    return vectors.select("word", F.size(vector_to_array("vector")).alias("width"))


_SAID_TOKENS = """list_filter(string_split_regex(sntnce, '\\s+'), lambda t: t <> '')"""
_INFORMATION_SQL = V.with_ctes(["u"], f""", t AS (SELECT row_number() OVER () AS of, {_SAID_TOKENS} AS tokens FROM u),
    x AS (SELECT of, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM t WHERE len(tokens) > 1),
    p AS (SELECT a.word, b.word AS context, count(*) AS n FROM x a JOIN x b ON a.of = b.of
          AND abs(a.pos - b.pos) BETWEEN 1 AND {fv.WORD_VECTOR_PARAMS['windowSize']} GROUP BY ALL),
    w AS (SELECT word, sum(n) AS n FROM p GROUP BY word)
    SELECT p.word, p.context, p.n::BIGINT AS n, round(ln(p.n * (SELECT sum(n) FROM w) / (wa.n::DOUBLE * wb.n)), 6) AS value
    FROM p JOIN w wa ON wa.word = p.word JOIN w wb ON wb.word = p.context
    WHERE p.n * (SELECT sum(n) FROM w) > wa.n::DOUBLE * wb.n""")


def _said_tokens(spark, d):
    return V.utterances(spark, d).select(TX.words_of(F.col("sntnce")).alias("tokens"))


@query("m10_pair_information", _INFORMATION_SQL)
def m10_information(spark, d):
    """What word vectors are made of: the information of every pair of words in a window."""
    found = WV.pair_information(WV.pair_counts(_said_tokens(spark, d), "tokens"))
    return found.select("word", "context", "n", F.round("value", 6).alias("value"))


@query(
    "m10_word_tables",
    """SELECT word, 200 AS width, TRUE AS of_the_matrix FROM (SELECT DISTINCT unnest(string_split_regex(sntnce, '\\s+')) AS word FROM u)
       WHERE word <> ''""",
    ["u"],
)
def m10_tables(spark, d):
    """A vector of 200 numbers for every word, and whether each dimension solves the stated problem.

    A dimension v of an eigenvector with eigenvalue e has the squared length |e|, and the matrix gives v M v = e |e|.
    """
    said = _said_tokens(spark, d)
    vectors = stage(WV.word_vectors(said, "tokens"))
    times = lambda a, b: array_to_vector(F.zip_with(a, b, lambda x, y: x * y))
    images = WV.with_images(WV.pair_information(WV.pair_counts(said, "tokens")), vectors).filter("image is not null")
    forms = images.agg(vector_to_array(Summarizer.sum(times("vector", "image"))).alias("forms"))
    lengths = vectors.agg(vector_to_array(Summarizer.sum(times("vector", "vector"))).alias("lengths"))
    # one row each
    close = F.forall(F.zip_with("forms", "lengths", lambda a, b: F.abs(F.abs(a) - b * b) <= 1e-6 * b * b), lambda ok: ok)
    solved = forms.join(F.broadcast(lengths)).select(close.alias("of_the_matrix"))
    return vectors.select("word", F.size("vector").alias("width")).join(F.broadcast(solved))


def _pairs_sql(source: str) -> str:
    return f"""WITH t AS ({source}),
    w AS (SELECT w, count(*) AS n FROM (SELECT unnest(tokens) AS w FROM t) GROUP BY w),
    p AS (SELECT a, b, count(*) AS n FROM (SELECT unnest(tokens[1:len(tokens) - 1]) AS a, unnest(tokens[2:]) AS b
          FROM t WHERE len(tokens) > 1) GROUP BY a, b)
    SELECT p.a, p.b, p.n AS n_ab, round((p.n - 5) * CAST((SELECT count(*) FROM w) + (SELECT count(*) FROM p) AS DOUBLE) / (wa.n * wb.n), 6) AS score
    FROM p JOIN w wa ON wa.w = p.a JOIN w wb ON wb.w = p.b
    WHERE p.n >= 5 AND (p.n - 5) * CAST((SELECT count(*) FROM w) + (SELECT count(*) FROM p) AS DOUBLE) / (wa.n * wb.n) > 10"""


_PAIRS_SQL = _pairs_sql(_TOKENS_SQL)


@query("m11_pair_scores", _PAIRS_SQL)
def m11(spark, d):
    found = LX.pair_scores(tokens(spark, d), "tokens")
    return found.select("a", "b", "n_ab", F.round("score", 6).alias("score"))


def _merged_sql(source: str) -> str:
    return f"""WITH good AS ({_pairs_sql(source)}), t AS ({source}),
    x AS (SELECT doc_id, unnest(tokens) AS a, unnest(list_concat(tokens[2:], [NULL])) AS b,
          generate_subscripts(tokens, 1) - 1 AS pos FROM t WHERE len(tokens) > 0),
    y AS (SELECT x.*, good.n_ab IS NOT NULL AS starts FROM x LEFT JOIN good ON good.a = x.a AND good.b = x.b),
    r AS (SELECT *, starts AND (pos - coalesce(max(CASE WHEN NOT starts THEN pos END) OVER w, -1)) % 2 = 1 AS merges
          FROM y WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    k AS (SELECT *, coalesce(lag(merges) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS taken FROM r)
    SELECT t.doc_id, coalesce(list(CASE WHEN merges THEN k.a || ' ' || k.b ELSE k.a END ORDER BY pos) FILTER (WHERE k.a IS NOT NULL), []) AS tokens
    FROM t LEFT JOIN (SELECT * FROM k WHERE NOT taken) k USING (doc_id) GROUP BY t.doc_id"""


def _joined_sql(merged: str) -> str:
    return f"SELECT doc_id, array_to_string(tokens, '|') AS tokens FROM ({merged})"


@query("m11_merged_pairs", _joined_sql(_merged_sql(_TOKENS_SQL)))
def m11_pairs(spark, d):
    rows = tokens(spark, d)
    merged = LX.merge_pairs(rows, "doc_id", "tokens", stage(LX.pair_scores(rows, "tokens")))
    return merged.select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@query("m11_merged_triples", _joined_sql(_merged_sql(_merged_sql(_TOKENS_SQL))))
def m11_triples(spark, d):
    merged, _, _ = LX.detect_collocations(tokens(spark, d), "doc_id", "tokens")
    return merged.select("doc_id", F.array_join("tokens", "|").alias("tokens"))
