"""From raw documents to a tokenised training mix, in five stages.

Each stage takes the rows that the one before it kept, written as Parquet.
All but the last return the columns of ``documents``.

What a stage has staged for itself is deleted when the next one is called, so
its result has to be written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import byte_bpe, language_id, minhash_dedup, source_mix, toxicity
from callsift.llm.queries import tokenizer
from callsift.session import apply_defaults, delete_path, shared_path, stage, staged

#: From this probability on a document counts as toxic.
TOXIC = 0.7


NEEDED = ("doc_id", "text", "lang", "source")


def _packed(docs: DataFrame) -> DataFrame:
    """The columns that stages work on, and all others out of the way in a structure."""
    others = [c for c in docs.columns if c not in NEEDED]
    return docs.select(*NEEDED, F.struct(*others).alias("_others"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in NEEDED else F.col("_others").getField(c).alias(c) for c in docs.columns])


_left: list[str] = []


def _tidy(function):
    """Delete what the stage before has staged; its result is written."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            delete_path(spark, _left.pop())
        before = set(staged(spark))
        result = function(spark, docs, sf_dir)
        _left.extend(path for path in staged(spark) if path not in before)
        return result

    return run


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Write the result of a stage to the shared folder and read it again."""
    path = shared_path(spark, "pipeline")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: null texts and texts without a letter.

    If no row has a language to learn from, nothing can be told and all
    documents are rejected.
    """
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"), 4, 2)), "text", "lang")
    told = language_id.predict(_packed(docs), "text", model)
    return _unpacked(told.filter(F.col("lang_pred") != language_id.UNDETERMINED), docs)


@_tidy
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic.  Labels of every third document are not learned from."""
    labels = apply_defaults(spark).read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    return _unpacked(toxicity.score(_packed(docs), "text", model).filter(F.col("score") < TOXIC), docs)


@_tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that of the least id, then of the least digest.

    Each row counts by its text alone, whether its id is repeated or null; a
    row with an id goes before one without.
    """
    rows = stage(_packed(docs).withColumn("_row", F.monotonically_increasing_id()))
    found = minhash_dedup.near_duplicates(rows, "_row", "text").select("_row", "component_id")
    digest = F.xxhash64(*NEEDED, "_others")
    order = rows.select("_row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", digest.alias("digest"), "_row").alias("_order"))
    first = found.join(order, "_row").groupBy("component_id").agg(F.min("_order").alias("_first"))
    return _unpacked(rows.join(first.select(F.col("_first._row").alias("_row")), "_row", "left_semi"), docs)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that sources come to their shares.  A document stands there as often as it is taken."""
    mixed = source_mix.mix(docs, "doc_id", "source", source_mix.word_count(F.col("text")), carry=docs.columns)
    times = F.array_repeat(F.lit(0), F.col("repeats").cast("int"))
    return mixed.select("carried", F.explode(times)).select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])


@_tidy
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the bytes that they decode to."""
    coded = byte_bpe.encode_and_decode(docs.select("doc_id", "source", "text"), "text", *tokenizer())
    return coded.select(
        "doc_id",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenise),
]

#: SQL expresses none of the learned stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = apply_defaults(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        rows = stored(spark, function(spark, rows, sf_dir))
    return rows
