"""The queries of this subpackage: each operator over its whole table, with the columns it is to return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import (
    byte_bpe,
    centroid_clusters,
    chat_format,
    fingerprints,
    html_content,
    language_id,
    minhash_dedup,
    sharding,
    source_mix,
    toxicity,
    url_filter,
    vector_codes,
    vector_dedup,
)
from callsift.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def oracle(sql: str):
    """States a query in DuckDB's SQL over the tables by name."""

    def register(function):
        ORACLES[function.__name__] = sql
        return function

    return register


#: Least node that links (a, b), both ways, lead to, for each of ``nodes`` (node).
_REACHED = """reached AS (SELECT node AS a, node AS b FROM nodes UNION
    SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
    grouped AS (SELECT a AS node, min(b) AS component_id FROM reached GROUP BY 1)"""
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Vectors whose components are all finite numbers.
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
#: Floor of a quotient of whole numbers, for a positive divisor.
_FLOOR = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def _rounds_of_clusters(rounds: int) -> str:
    """Tables c0, a0, c1, a1, ... of op12: centroids by component, and the nearest one of each row."""
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""c{r} AS MATERIALIZED (SELECT c, d, coalesce(CAST(x1 AS BIGINT), x) AS x FROM c{r - 1} LEFT JOIN
                (SELECT c, d, {_FLOOR} AS x1 FROM (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{r - 1} JOIN cells USING (nr) GROUP BY ALL)) USING (c, d))""")
        steps.append(f"""a{r} AS MATERIALIZED (SELECT nr, min(c) AS c, min(apart) AS apart FROM (SELECT *, min(apart) OVER (PARTITION BY nr) AS least
            FROM (SELECT nr, c, CAST(sum((v.x - w.x) * (v.x - w.x)) AS BIGINT) AS apart FROM cells v JOIN c{r} w USING (d) GROUP BY ALL)) WHERE apart = least GROUP BY nr)""")
    return ",\n".join(steps)


def _rounds_of_codes(rounds: int) -> str:
    """Tables c0, a0, c1, a1, ... of op13: codebooks by part, entry and component, and the nearest entry of each part of a row."""
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""c{r} AS MATERIALIZED (SELECT p, c, d, coalesce(CAST(x1 AS BIGINT), x) AS x FROM c{r - 1} LEFT JOIN
                (SELECT p, c, d, {_FLOOR} AS x1 FROM (SELECT p, c, d, sum(x) AS s, count(*) AS n FROM a{r - 1} JOIN cells USING (nr, p) GROUP BY ALL)) USING (p, c, d))""")
        steps.append(f"""a{r} AS MATERIALIZED (SELECT nr, p, min(c) AS c, min(apart) AS apart FROM (SELECT *, min(apart) OVER (PARTITION BY nr, p) AS least
            FROM (SELECT nr, p, c, CAST(sum((v.x - w.x) * (v.x - w.x)) AS BIGINT) AS apart FROM cells v JOIN c{r} w USING (p, d) GROUP BY ALL)) WHERE apart = least GROUP BY nr, p)""")
    return ",\n".join(steps)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return apply_defaults(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Place of the rank file and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = byte_bpe.encode_and_decode(table(spark, folder, "documents").select("doc_id", "text"), "text", *tokenizer())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
@oracle(
    f"""WITH sized AS (SELECT doc_id, source, len({_WORDS}) AS size, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size,
        CAST((row_number() OVER (ORDER BY source IS NULL, CAST(source AS BLOB)) - 1) % 3 + 1 AS DOUBLE) AS weight FROM sized GROUP BY source),
    capped AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS ratio FROM sources),
    levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) /
        (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
        FROM capped WINDOW before AS (ORDER BY ratio, cap, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    filled AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target FROM levels),
    placed AS (SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
        sum(size) OVER (PARTITION BY sized.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
        FROM sized JOIN filled ON sized.source IS NOT DISTINCT FROM filled.source)
    SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN target - whole * source_size > 0
        AND upto - size / 2 < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM placed"""
)
def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, folder, "documents"), "doc_id", "source", source_mix.word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(documents, labels.filter(~toxicity.held_out(F.col("doc_id"))), "doc_id", "text", "toxic")
    scored = toxicity.score(documents.select("doc_id", "text"), "text", model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op4_html_content(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_content.extract_content(table(spark, folder, "pages").select("page_id", "url", "html"), "html")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, folder, "documents"), "doc_id", "text")


@query
@oracle(
    f"""WITH RECURSIVE nodes AS (SELECT vec_id AS node FROM embeddings),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id
        AND list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) >= 0.95), {_REACHED}
    SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, component_id, node = component_id AS kept FROM grouped"""
)
def op6_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")


#: One more conversation: both turns hold nothing but control strings.
CONFLICT = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


@query
@oracle(
    """WITH said AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
    lengths AS (SELECT *, length(text) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 17 END
        + CASE WHEN conv_id = -7 THEN 3 ELSE 0 END AS n FROM said)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(n)::BIGINT + 10 AS formatted_chars FROM lengths GROUP BY conv_id"""
)
def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONFLICT, said.schema)
    formatted = chat_format.format_conversations(said.unionByName(more), "conv_id", "turn", "role", "text")
    return chat_format.read_back(formatted, "conv_id")


@query
@oracle(
    f"""WITH RECURSIVE worded AS (SELECT doc_id, list_transform({_WORDS},
        lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words FROM documents),
    shingled AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS found FROM worded),
    sizes AS (SELECT doc_id, len(found) AS n_shingles FROM shingled),
    each AS (SELECT doc_id, unnest(found) AS shingle FROM shingled),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM each x JOIN each y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * n >= 75 * (p.n_shingles + q.n_shingles - n)),
    nodes AS (SELECT doc_id AS node FROM documents), {_REACHED}
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN grouped ON node = doc_id"""
)
def op8_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"), "doc_id", "text")


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = sharding.shard(
        table(spark, folder, "documents"),
        "doc_id",
        text,
        F.octet_length(text).cast("long") + 16,
        shards=40,
        carry={"text_crc32": F.crc32(text.cast("binary"))},
    )
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(documents.filter(~held_out), "text", "lang")
    scored = language_id.predict(documents.select("doc_id", "text"), "text", model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: The rules of the query on URLs.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    model = url_filter.fit(url_filter.labelled_urls(spark), "url", "block")
    return url_filter.judge(pages, "page_id", "url", spark.createDataFrame(URL_RULES, "rule string, verdict string"), model)


@query
@oracle(
    f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
    cells AS MATERIALIZED (SELECT nr, unnest(range(64)) AS d, unnest(x) AS x FROM kept),
    firsts AS (SELECT nr, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c FROM kept),
    c0 AS MATERIALIZED (SELECT c, d, cells.x FROM firsts JOIN cells USING (nr) WHERE c < 40),
    {_rounds_of_clusters(5)},
    digests AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c5 GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, apart AS distance, CAST(sum(apart) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
        CAST(sum(apart) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a5 JOIN kept USING (nr) JOIN digests USING (c)"""
)
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, folder, "embeddings"), "vec_id", "embedding")


@query
@oracle(
    f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS nr, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE {_FINITE}),
    cells AS MATERIALIZED (SELECT nr, i // (w // 4) AS p, i % (w // 4) AS d, x FROM (SELECT nr, len(x) AS w, unnest(range(len(x))) AS i, unnest(x) AS x FROM kept)),
    firsts AS (SELECT nr, row_number() OVER (ORDER BY vec_id, x) - 1 AS c FROM kept),
    c0 AS MATERIALIZED (SELECT p, c, d, cells.x FROM firsts JOIN cells USING (nr) WHERE c < 256),
    {_rounds_of_codes(4)},
    coded AS (SELECT nr, string_agg(lower(printf('%02x', CAST(c AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(apart) AS BIGINT) AS error FROM a4 GROUP BY nr)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, c, d)) FROM c4) AS codebooks_sha256 FROM coded JOIN kept USING (nr)"""
)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")[0]
