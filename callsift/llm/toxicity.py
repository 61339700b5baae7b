"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Learning is on-line: each labelled text moves only the weights it touches, at
rates of their own, and the L1 term keeps most weights at exactly zero.  It
runs on a bounded sample of labelled rows (``Settings.most_rows`` and
``most_found``), in one task; what leaves that task are the non-zero weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.words import NOT_ALPHANUMERIC, chunks, mix, word_hashes
from callsift.session import stage


@dataclass(frozen=True)
class Settings:
    """``skips``: distances between the two words of a pair, 1 for neighbours.

    ``most_rows`` bounds the labelled rows that are learned from: those with
    the smallest seeded hash of their key.  Of these, in the order of a hash,
    rows are taken as long as they have ``most_found`` features together (4
    bytes each).  ``features`` bounds the weights.
    """

    features: int = 1 << 22
    skips: tuple[int, ...] = (1, 2, 3)
    alpha: float = 6.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0
    epochs: int = 6
    most_rows: int = 16_000
    most_found: int = 60_000_000
    seed: int = 7


def features(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, text by text, and their number.

    Words are runs of ASCII letters, ASCII digits and characters beyond ASCII,
    ASCII letters lower-cased.  Each word and each pair of words at one of the
    distances is a feature.
    """
    hashes, counts = word_hashes(texts, NOT_ALPHANUMERIC)
    owner = np.repeat(np.arange(len(counts)), counts)
    found, owners = [hashes], [owner]
    for skip in settings.skips:
        if len(hashes) > skip:
            same = owner[:-skip] == owner[skip:]
            pair = hashes[:-skip][same] * np.uint64(0x9E3779B97F4A7C15) + hashes[skip:][same] + np.uint64(skip)
            found.append(mix(pair))
            owners.append(owner[:-skip][same])
    bucket = np.concatenate(found) % np.uint64(settings.features)
    keys = np.sort(np.concatenate(owners).astype(np.int64) * settings.features + bucket.astype(np.int64))
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return (keys % settings.features).astype(np.int32), np.bincount(keys // settings.features, minlength=len(counts))


class Ftrl:
    """FTRL-proximal for 0/1 features (McMahan et al., "Ad Click Prediction")."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.z = np.zeros(settings.features + 1)  # the last is the intercept
        self.n = np.zeros(settings.features + 1)

    def weights(self, at) -> np.ndarray:
        s, z = self.settings, self.z[at]
        lean = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        shrunk = np.maximum(np.abs(z) - np.where(at == s.features, 0.0, s.l1), 0.0)
        return -np.sign(z) * shrunk / lean

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, self.settings.features)
        w = self.weights(at)
        gradient = sigmoid(w.sum()) - label
        rate = (np.sqrt(self.n[at] + gradient * gradient) - np.sqrt(self.n[at])) / self.settings.alpha
        self.z[at] += gradient - rate * w
        self.n[at] += gradient * gradient


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def sample(keys: DataFrame, key: str, settings: Settings) -> DataFrame:
    """At most ``most_rows`` rows, those of the smallest hash; fewer rows stay as they are."""
    return keys.orderBy(F.xxhash64(F.lit(settings.seed), F.col(key)), F.col(key)).limit(settings.most_rows)


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    intercept: float
    settings: Settings


def fit(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings = Settings()) -> Model:
    """Learn from labelled documents.

    ``labels`` holds key and label (0 or 1) of the rows to learn from; rows
    without a key or label, or without a document, count for nothing.  A label
    that is repeated counts once, contradicting labels count as 1.
    """
    known = labels.select(key, F.col(label).cast("int").alias("_label")).dropna().groupBy(key).agg(F.max("_label").alias("_label"))
    # bounded by most_rows: some bytes a row
    chosen = F.broadcast(stage(sample(known, key, settings)))
    texts = documents.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = texts.join(chosen, key).select(
        F.xxhash64(F.lit(settings.seed + 1), key).alias("_order"), "_text", "_label"
    )

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            found, counts = features(part.column("_text"), settings)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(found))
            columns = [part.column("_order"), part.column("_label"), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["_order", "_label", "_found"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, labels, sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for batch in batches:
            orders.append(batch.column("_order").to_numpy())
            labels.append(batch.column("_label").to_numpy())
            sizes.append(batch.column("_found").value_lengths().to_numpy().astype(np.int64))
            flat.append(batch.column("_found").flatten().to_numpy())
        order, label, size, flat = (np.concatenate(x) for x in (orders, labels, sizes, flat))
        ends = np.cumsum(size)
        rows = np.lexsort((size, label, order))
        model = Ftrl(settings)
        for epoch in range(settings.epochs):
            for i in rows[np.random.default_rng(settings.seed + epoch).permutation(len(rows))]:
                model.learn(flat[ends[i] - size[i] : ends[i]], label[i])
        weights = model.weights(np.arange(settings.features + 1))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(used.astype(np.int32)), "weight": pa.array(weights[used])})

    found = stage(rows.mapInArrow(grams, "_order long, _label int, _found array<int>").withColumn("_row", F.monotonically_increasing_id()))
    # most_rows rows of four numbers
    upto = F.sum("_size").over(Window.orderBy("_order", "_label", "_size", "_row"))
    sized = found.select("_order", "_label", F.size("_found").alias("_size"), "_row").filter(F.col("_size") <= settings.most_found).withColumn("_upto", upto)
    within = sized.filter(F.col("_upto") <= settings.most_found).select("_row")
    learned = found.join(F.broadcast(within), "_row", "left_semi").drop("_row").repartition(1).mapInArrow(learn, "feature int, weight double")
    weights = {r["feature"]: r["weight"] for r in learned.collect()}  # at most ``features`` rows
    intercept = weights.pop(settings.features, 0.0)
    return Model(weights, intercept, settings)


def score(df: DataFrame, text: str, model: Model, out: str = "score") -> DataFrame:
    """Add the probability of label 1.  A null or empty text has the probability that the intercept gives."""
    dense = np.zeros(model.settings.features)
    dense[list(model.weights)] = list(model.weights.values())
    # the vector is rebuilt on executors: only non-zero weights travel
    shared = df.sparkSession.sparkContext.broadcast(
        (np.flatnonzero(dense).astype(np.int32), dense[np.flatnonzero(dense)], model.intercept, model.settings)
    )
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, intercept, settings = shared.value
        weights = np.zeros(settings.features)
        weights[at] = values
        for part in chunks(batches, text):
            found, counts = features(part.column(text), settings)
            owner = np.repeat(np.arange(len(counts)), counts)
            total = np.bincount(owner, weights=weights[found], minlength=len(counts)) + intercept
            columns = [*(part.column(c) for c in kept), pa.array(sigmoid(total))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*kept).mapInArrow(run, schema)


def held_out(key: Column, parts: int = 3, part: int = 1) -> Column:
    """Whether crc32 of the key as text falls on ``part``; a null key is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(True))
