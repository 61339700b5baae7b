"""Chunk features, labels, assembling and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.regex import start_totals
from callsift.functions.text import remove_tokens, training_tokens
from callsift.functions.vectors import let
from callsift.operators.calls import ID
from callsift.operators.intents import Pack as Intents
from callsift.operators.intents import intent_distances
from callsift.operators.lexicon import replace_words, replace_words_by_join
from callsift.operators.ordering import hash_ranks
from callsift.operators.rules import (
    Pack,
    balanced,
    is_customer,
    non_empty,
    preselect,
    without,
)
from callsift.session import stage


TABULAR = ["sntce_len", "rel_pos_sntce"]
FEATURE_COLUMNS = ["conv_id", "chunk_id", *TABULAR, "intent"]


def customer_chunks(
    said: DataFrame,
    words: Sequence[str] = fv.FILLER_WORDS,
    tags: Sequence[str] = fv.TAGS,
) -> DataFrame:
    """Cleaned customer sentences; order is carried by ``chunk_id``."""
    return said.filter(is_customer(F.col("sntnce_partcpnt_role"))).select(
        ID, "chunk_id", cleaned(F.col("sntnce"), words, tags).alias("text")
    )


def cleaned(
    text: Column, words: Sequence[str] = fv.FILLER_WORDS, tags: Sequence[str] = fv.TAGS
) -> Column:
    return remove_tokens(text, [*tags, *words])


def relative_position(text: Column, patterns: Sequence[str] = fv.PATTERNS["movers"]) -> Column:
    """Mean start of the matches over the length of the text; -1 without any."""
    return let(
        start_totals(text, patterns),
        lambda found: F.when(
            found["n"] > 0, found["total"] / (F.length(text).cast("double") * found["n"])
        ).otherwise(F.lit(-1.0)),
    )


def chunk_features(
    chunks: DataFrame,
    pack: Intents,
    patterns: Sequence[str] = fv.PATTERNS["movers"],
    text: str = "text",
    **encoder,
) -> DataFrame:
    """M1: one row of features per non-empty cleaned chunk."""
    (intent,) = pack.sizes()
    kept = non_empty(chunks, text)
    scored = intent_distances(kept, text, pack, "all", **encoder).withColumnRenamed(
        intent, "intent"
    )
    extra = [c for c in chunks.columns if c not in (ID, "chunk_id", text)]
    rows = scored.select(
        F.col(ID).alias("conv_id"),
        "chunk_id",
        F.length(text).alias("sntce_len"),
        relative_position(F.col(text), patterns).alias("rel_pos_sntce"),
        "intent",
        *extra,
    )
    missing = [c for c in FEATURE_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"features lack {missing}")
    return rows


def attach_labels(chunks: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled chunks only, matched on conversation and chunk as text."""
    known = labels.select(
        F.col("conv_id").alias(ID), F.col("chunk_id").cast("string").alias("_chunk"), "label"
    )
    return (
        chunks.withColumn("_chunk", F.col("chunk_id").cast("string"))
        .join(known, [ID, "_chunk"])
        .drop("_chunk")
    )


def conversation_features(
    slim: DataFrame,
    pack: Intents,
    patterns: Pack = fv.PATTERNS,
    labels: DataFrame | None = None,
    words: Sequence[str] = fv.FILLER_WORDS,
    tags: Sequence[str] = fv.TAGS,
    mode: str | None = "after",
    **encoder,
) -> DataFrame:
    """M2: pre-selection, removal, cleaning and features of numbered slim sentences.

    Encoding sees only the rows that the rules have left.
    """
    selected, removed = preselect(slim, patterns, mode=mode)
    left = selected if mode is None else without(selected, removed)
    chunks = left.select(
        ID, "chunk_id", cleaned(F.col("sntnce"), words, tags).alias("text")
    )
    if labels is not None:
        chunks = attach_labels(chunks, labels)
    # few and short rows, but each is costly from here on: even them out over
    # all cores, whatever their conversation
    cores = slim.sparkSession.sparkContext.defaultParallelism
    chunks = chunks.repartition(2 * cores, ID, "chunk_id")
    return chunk_features(chunks, pack, patterns["movers"], **encoder)


def feature_names(n_intents: int) -> list[str]:
    return [*TABULAR, *[f"intent_{j}" for j in range(n_intents)]]


def feature_array(features: DataFrame) -> DataFrame:
    """M3: tabular features followed by the intent distances, as one array."""
    tabular = F.array(*[F.col(c).cast("double") for c in TABULAR])
    return features.withColumn("features", F.concat(tabular, F.col("intent"))).drop(
        *TABULAR, "intent"
    )


def assemble(features: DataFrame, n_intents: int) -> DataFrame:
    """M3 for the ML library: a vector column that carries the feature names."""
    from pyspark.ml.functions import array_to_vector

    names = feature_names(n_intents)
    meta = {
        "ml_attr": {
            "attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]},
            "num_attrs": len(names),
        }
    }
    rows = feature_array(features)
    return rows.withColumn("features", array_to_vector("features").alias("features", metadata=meta))


def clean_annotations(rows: DataFrame, row_order: str) -> tuple[DataFrame, DataFrame]:
    """(sentences, labels) of an annotation table.

    Rows without a label go; ``N`` is 0, anything else 1.  A repeated chunk
    takes the label of its last row, while all its sentences stay.
    """
    kept = rows.filter(F.col("label").isNotNull()).withColumn(
        "target", F.when(F.col("label") == "N", 0).otherwise(1)
    )
    chunk = F.col("chunk_id").cast("string")
    labels = kept.groupBy("conv_id", chunk.alias("chunk_id")).agg(
        F.max_by("target", row_order).alias("label")
    )
    said = kept.select(
        F.col("conv_id").alias(ID),
        chunk.alias("chunk_id"),
        "sntnce",
        F.lit(fv.CUSTOMER_ROLE).alias("sntnce_partcpnt_role"),
    )
    return said, labels


def split_rows(
    df: DataFrame,
    ratio: float,
    hash_column: Column,
    hash_range: int,
    tie: Sequence[str],
    staged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test); the first ``ceil(ratio * n)`` rows in hash order are the test.

    ``staged``: the rows and their ranks are stored, so that ``df`` is worked
    out once for all that reads the parts, and rows equal in ``tie`` are in one
    part only.
    """
    if staged:
        df = stage(df)
    ranked = hash_ranks(df, hash_column, hash_range, tie, out="_rank")
    if staged:
        ranked = stage(ranked)
    size = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(ratio))).scalar()
    train = ranked.filter(F.col("_rank") > size).drop("_rank")
    test = ranked.filter(F.col("_rank") <= size).drop("_rank")
    return train, test


def split_conversations(
    df: DataFrame, ratio: float, hash_column: Column, hash_range: int, key: str = "conv_id"
) -> tuple[DataFrame, DataFrame]:
    """W7 by conversation: all rows of a conversation go to one side."""
    ids = df.select(key).distinct()
    _, test = split_rows(ids, ratio, hash_column, hash_range, [key])
    return df.join(test, key, "left_anti"), df.join(test, key, "left_semi")


def training_text(
    df: DataFrame,
    text: str,
    words: Sequence[str],
    tags: Sequence[str] | None,
    forms: Mapping[str, str] | DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Normalised text, words joined by blanks.

    ``forms`` may be a table ``(form, lemma)`` of any size; that takes ``key``,
    a unique column.
    """
    tokens = training_tokens(F.col(text), words, tags)
    if isinstance(forms, DataFrame):
        if key is None:
            raise ValueError("a table of forms takes a unique key")
        replaced = replace_words_by_join(df.withColumn("_words", tokens), key, "_words", forms)
        return replaced.withColumn("text_clean", F.array_join("_words", " ")).drop("_words")
    if forms:
        tokens = replace_words(tokens, forms)
    return df.withColumn("text_clean", F.array_join(tokens, " "))


def build_training_data(
    df: DataFrame,
    text: str,
    label: str,
    hash_column: Column,
    hash_range: int,
    tie: Sequence[str],
    words: Sequence[str] = (),
    tags: Sequence[str] | None = None,
    forms: Mapping[str, str] | DataFrame | None = None,
    ratio: float = fv.TEST_RATIO_TEXT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M9: (all, train, test) of a text training set with equal classes."""
    equal = balanced(df, label, hash_column, hash_range, tie)
    whole = training_text(equal, text, words, tags, forms, tie[0])
    train, test = split_rows(whole, ratio, hash_column, hash_range, tie)
    columns = [*tie, F.col("text_clean").alias("x"), F.col(label).alias("y")]
    return whole.select(*columns), train.select(*columns), test.select(*columns)
