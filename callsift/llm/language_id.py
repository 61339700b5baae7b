"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is one pass over the learning rows, in which every task adds up its
own table of counts.  The model is a matrix (languages x buckets) of log
probabilities.  One matrix of bounded size is broadcast at a time: with more
languages than it holds, the texts are scored by one block of languages after
the other, keeping the best so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.llm.words import chunks, mix
from callsift.session import stage

UNDETERMINED = "und"
#: Characters that are hashed together: numpy needs some 60 bytes for each.
WINDOW = 250_000


@dataclass(frozen=True)
class Settings:
    """``orders``: lengths of n-grams; ``buckets``: columns of the matrix; ``smoothing``: added to every count;
    ``most_cells``: cells of a broadcast matrix (4 bytes each)."""

    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 14
    smoothing: float = 0.5
    most_cells: int = 32_000_000


def gram_buckets(texts: list[str | None], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of n-grams, and the place of the text that each is of, some at a time.

    Texts are lower-cased and stand between two spaces; no n-gram crosses
    texts.  A text of any length is hashed window by window.
    """
    padded = [f" {(t or '').lower()} " for t in texts]
    ends = np.cumsum(np.fromiter(map(len, padded), np.int64, len(padded)))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    del padded
    longest = max(settings.orders)
    for start in range(0, len(points), WINDOW):
        some = mix(points[start : start + WINDOW + longest - 1].astype(np.uint64) + np.uint64(1))
        doc = np.searchsorted(ends, np.arange(start, start + len(some)), side="right").astype(np.int32)
        rolled = some
        for order in range(1, longest + 1):
            # n-grams that begin in this window
            n = min(WINDOW, len(some) - order + 1)
            if n <= 0:
                break
            if order > 1:
                rolled = rolled[: len(some) - order + 1] * np.uint64(0x9E3779B97F4A7C15) + some[order - 1 :]
            if order in settings.orders:
                whole = doc[:n] == doc[order - 1 : order - 1 + n]
                hashed = mix(rolled[:n][whole] + np.uint64(order)) % np.uint64(settings.buckets)
                yield hashed.astype(np.int32), doc[:n][whole]


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def count_grams(df: DataFrame, text: str, lang: str, settings: Settings = Settings()) -> DataFrame:
    """(lang, bucket, n) over all rows that have a text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks([batch], "text"):
                names = np.asarray(part.column("lang").to_pylist(), object)
                texts = np.asarray(part.column("text").to_pylist(), object)
                for name in set(names):
                    counted = tables.setdefault(name, np.zeros(settings.buckets, np.int64))
                    for buckets, _ in gram_buckets(texts[names == name].tolist(), settings):
                        counted += np.bincount(buckets, minlength=settings.buckets)
        for name, counted in tables.items():
            used = np.flatnonzero(counted)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * len(used), pa.string()),
                    "bucket": pa.array(used.astype(np.int32)),
                    "n": pa.array(counted[used].astype(np.int64)),
                }
            )

    rows = df.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counted = rows.mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """``langs``: the learned languages in order; ``counted``: (lang, bucket, n), staged."""

    langs: tuple[str, ...]
    counted: DataFrame
    settings: Settings

    def blocks(self) -> Iterator[tuple[tuple[str, ...], np.ndarray]]:
        """Languages, some at a time, with their matrix (buckets x languages) of log probabilities."""
        s = self.settings
        most = max(1, s.most_cells // s.buckets)
        for at in range(0, len(self.langs), most):
            langs = self.langs[at : at + most]
            place = {name: i for i, name in enumerate(langs)}
            mine = self.counted if len(langs) == len(self.langs) else self.counted.filter(F.col("lang").between(langs[0], langs[-1]))
            cells = F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("cells")
            matrix = np.full((s.buckets, len(langs)), s.smoothing)
            for row in mine.groupBy("lang").agg(cells).toLocalIterator():
                found = np.array([(c["bucket"], c["n"]) for c in row["cells"]], np.int64).reshape(-1, 2)
                matrix[found[:, 0], place[row["lang"]]] += found[:, 1]
            yield langs, np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def fit(df: DataFrame, text: str, lang: str, settings: Settings = Settings()) -> Model:
    """The model of all given rows; languages are equally likely beforehand.

    Rows without a text or language are left out.  What comes to the driver
    are the names of the languages and, block by block, one number for each
    language and bucket.
    """
    counted = stage(count_grams(df, text, lang, settings))
    return Model(tuple(sorted(r["lang"] for r in counted.select("lang").distinct().collect())), counted, settings)


def log_likelihoods(texts: list[str | None], weights: np.ndarray, settings: Settings) -> np.ndarray:
    """texts x languages: log probability of each text's n-grams."""
    totals = np.zeros((len(texts), weights.shape[1]))
    for buckets, owner in gram_buckets(texts, settings):
        if not len(owner):
            continue
        first, last = int(owner[0]), int(owner[-1]) + 1
        for at in range(weights.shape[1]):
            totals[first:last, at] += np.bincount(owner - first, weights=weights[buckets, at], minlength=last - first)
    return totals


def predict(df: DataFrame, text: str, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability of that language among the learned ones.

    ``und`` with score 0 for a null text, one without any letter, or if
    nothing was learned.  Ties go to the language that sorts first.
    """
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    rows = df.select(*kept, has_letter(F.col(text)).alias("_letters"), F.lit(None).cast("string").alias("lang_pred"))
    # log likelihood of the best language, and the sum of all likelihoods next to it
    rows = rows.withColumns({"_best": F.lit(float("-inf")), "_sum": F.lit(0.0)})
    several = len(model.langs) * model.settings.buckets > model.settings.most_cells
    for langs, weights in model.blocks():
        rows = rows.mapInArrow(_scorer(df.sparkSession.sparkContext.broadcast((langs, weights)), text, model.settings), rows.schema)
        rows = stage(rows) if several else rows
    known = F.col("_letters") & F.col("lang_pred").isNotNull()
    return rows.select(
        *kept,
        F.when(known, F.col("lang_pred")).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(known, 1 / F.col("_sum")).otherwise(F.lit(0.0)).alias("score"),
    )


def _scorer(shared, text: str, settings: Settings):
    """Go on from the best language so far with a block of further ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights = shared.value
        for part in chunks(batches, text):
            letters = np.flatnonzero(part.column("_letters").to_numpy(zero_copy_only=False).astype(bool))
            names = np.asarray(part.column("lang_pred").to_pylist(), object)
            best, total = (part.column(c).to_numpy().copy() for c in ("_best", "_sum"))
            if len(letters):
                found = log_likelihoods(part.column(text).take(pa.array(letters)).to_pylist(), weights, settings)
                place = found.argmax(axis=1)
                top = found[np.arange(len(found)), place]
                mine = np.exp(found - top[:, None]).sum(axis=1)
                before, was = best[letters], total[letters]
                better = top > before
                names[letters[better]] = np.asarray(langs, object)[place[better]]
                best[letters] = np.maximum(top, before)
                total[letters] = was * np.exp(before - best[letters]) + mine * np.exp(top - best[letters])
            replaced = {"lang_pred": pa.array(names, pa.string()), "_best": pa.array(best), "_sum": pa.array(total)}
            yield pa.RecordBatch.from_arrays([replaced.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)

    return run


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text falls on ``part``; a null key is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(True))


def accuracy(predicted: pd.Series, truth: pd.Series) -> float:
    """Share of known languages that are predicted."""
    known = truth.notna()
    return float((predicted[known] == truth[known]).mean())
