"""Compression of vectors: a code for each part of a vector, from codebooks fitted in whole numbers.

The parts are sorted along a Hilbert curve and cut into flat blocks.  A block
stores its points, the box that holds them (least and greatest value of each
component) and their sums.  In every round the distances between box and
codebook entries leave a short list of entries for the block: an entry whose
least distance to the box exceeds the greatest distance of another one, or
which some entry beats all over the box, can be nearest to none of its points.
A block with one entry left is added by its sums; the points of others are
compared with their short list by a small kernel in exact whole numbers.

A round is one pass over the blocks; each task sends one row of sums for each
entry.  Only the codebooks are on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.centroid_clusters import add_up, digest, matrix, pieces, whole_numbers
from callsift.session import stage

#: Whole numbers below this are exact as doubles, so is any sum of them that stays below.
EXACT = 1 << 53
#: The Hilbert curve runs through this many components at most; it decides the order only.
CURVE = 21


@dataclass(frozen=True)
class Settings:
    """``scale``: a component x becomes floor(scale * x).  ``block``: points of a block."""

    parts: int = 4
    entries: int = 256
    scale: int = 1024
    rounds: int = 4
    block: int = 128


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2**bits; rows x dimensions, 63 bits together.

    Skilling's transposed form: undo the turns from the highest bit down, take
    the Gray code, then read the bits of all dimensions in turn.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = np.int64((1 << bit) - 1)
        for axis in x:
            turned = axis >> bit & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(turned, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> bit & 1 == 1, np.int64((1 << bit) - 1), 0)
    x ^= flip
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | axis >> bit & 1
    return place


def curve_places(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places of points on a grid between ``low`` and ``high``; points outside count as on its edge."""
    used = min(points.shape[1], CURVE)
    bits = min(16, 63 // used)
    span = np.maximum(high - low, 1)[:used]
    cells = (points[:, :used] - low[:used]) * (1 << bits) // (span + 1)
    return hilbert(np.clip(cells, 0, (1 << bits) - 1), bits)


def short_lists(low: np.ndarray, high: np.ndarray, middle: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries: whether an entry may be nearest to a point of the block's box, ties to the smaller number counted.

    Two tests: by least and greatest distances of the box, and against the
    entry that is nearest to ``middle`` (any point), all over the box.
    """
    lo, hi, c = low[:, None, :], high[:, None, :], entries[None, :, :]
    least = (np.maximum(np.maximum(lo - c, c - hi), 0) ** 2).sum(axis=2)
    most = (np.maximum(np.abs(c - lo), np.abs(hi - c)) ** 2).sum(axis=2)
    able = least <= most.min(axis=1, keepdims=True)
    rival = ((middle[:, None, :] - c) ** 2).sum(axis=2).argmin(axis=1)
    # greatest value over the box of |x - rival|^2 - |x - entry|^2, which is linear in x
    slope = 2 * (c - entries[rival][:, None, :])
    squares = (entries * entries).sum(axis=1)
    lead = np.maximum(slope * lo, slope * hi).sum(axis=2) + squares[rival][:, None] - squares[None, :]
    able &= (lead > 0) | ((lead == 0) & (np.arange(len(entries))[None, :] < rival[:, None]))
    able[np.arange(len(able)), rival] = True
    return able


def nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Place of the nearest entry of each point, ties to the first.  Exact: products are whole and too small to be rounded."""
    greatest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * greatest * greatest < EXACT:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    return ((entries * entries).sum(axis=1) - 2 * (points @ entries.T)).argmin(axis=1)


def _cut(rows: DataFrame, first: np.ndarray, settings: Settings) -> DataFrame:
    """Blocks of points in the order of the curve: part, points, rows, low, high, sums.

    ``rows``: _row and _x of one width.  The order is that of (part, place,
    row), dealt out by ranges of it, so equal points are dealt out as well.
    """
    width = first.shape[1] // settings.parts
    books = first.reshape(len(first), settings.parts, width)
    low, high = books.min(axis=0), books.max(axis=0)

    def to_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2000):
            x = matrix(batch.column("_x"), first.shape[1]).reshape(-1, settings.parts, width)
            for part in range(settings.parts):
                points = np.ascontiguousarray(x[:, part])
                columns = [
                    pa.array(np.full(len(points), part, np.int32)),
                    pa.array(curve_places(points, low[part], high[part])),
                    batch.column("_row"),
                    _lists(points.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["_part", "_place", "_row", "_point"])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            part = batch.column("_part").to_numpy()
            points = matrix(batch.column("_point"), width)
            ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
            starts = np.concatenate([np.arange(a, b, settings.block) for a, b in zip([0, *ends[:-1]], ends, strict=True)])
            stops = np.minimum(starts + settings.block, ends[np.searchsorted(ends, starts, side="right")])
            offsets = pa.array(np.append(starts, len(part)).astype(np.int32))
            columns = [
                pa.array(part[starts]),
                pa.array((stops - starts).astype(np.int32)),
                pa.ListArray.from_arrays(offsets, batch.column("_row")),
                pa.ListArray.from_arrays(pa.array(np.append(starts, len(part)).astype(np.int32) * width), pa.array(points.ravel().astype(np.int32))),
                _lists(np.minimum.reduceat(points, starts, axis=0)),
                _lists(np.maximum.reduceat(points, starts, axis=0)),
                _lists(np.add.reduceat(points, starts, axis=0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "n", "rows", "points", "low", "high", "sums"])

    points = rows.select("_row", "_x").mapInArrow(to_points, "_part int, _place long, _row long, _point array<int>")
    order = ["_part", "_place", "_row"]
    ordered = points.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(to_blocks, "part int, n int, rows array<long>, points array<int>, low array<long>, high array<long>, sums array<long>")


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _decided(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
    """(part, batch, place of a block in it, short list, points or None, entry of each point) of each block; no points where one entry is left."""
    width = books.shape[2]
    for batch in pieces(batches, 200):
        part = batch.column("part").to_numpy()
        n = batch.column("n").to_numpy()
        low, high, sums = (matrix(batch.column(c), width) for c in ("low", "high", "sums"))
        points = matrix(batch.column("points"), width)
        first = np.cumsum(n) - n
        for p in np.unique(part):
            mine = np.flatnonzero(part == p)
            able = short_lists(low[mine], high[mine], sums[mine] // n[mine, None], books[p])
            for at, lists in zip(mine.tolist(), able, strict=True):
                listed = np.flatnonzero(lists)
                held = points[first[at] : first[at] + n[at]]
                won = listed[nearest(held, books[p][listed])] if len(listed) > 1 else np.full(len(held), listed[0])
                yield int(p), batch, at, listed, sums[at], held, won


def _moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts x entries x width) after one round: floors of means, unused entries as before."""
    parts, entries, width = books.shape
    names = [f"x{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for part, _, _, listed, sums, points, won in _decided(batches, books):
            if len(listed) == 1:
                counts[part, listed[0]] += len(points)
                totals[part, listed[0]] += sums
            else:
                n, s = add_up(points, won, entries)
                counts[part] += n
                totals[part] += s
        part, entry = np.nonzero(counts)
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry])]
        columns += [pa.array(totals[part, entry, i]) for i in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *names])

    added = blocks.drop("rows").mapInArrow(run, "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names))
    totals = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
    after = books.copy()
    for row in totals.collect():  # a row for each entry at most
        after[row["part"], row["entry"]] = [row[c] // row["n"] for c in names]
    return after


def _together(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["row", "part", "entry", "error"])


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, part, entry, error) of every point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for part, batch, at, _, _, points, won in _decided(batches, books):
            apart = points - books[part][won]
            rows = batch.column("rows")[at].values.to_numpy()
            waiting.append((rows, np.full(len(won), part, np.int32), won.astype(np.int32), (apart * apart).sum(axis=1)))
            if len(waiting) == 100:
                yield _together(waiting)
                waiting = []
        if waiting:
            yield _together(waiting)

    return blocks.mapInArrow(run, "row long, part int, entry int, error long")


def compress(df: DataFrame, key: str, vector: str, label: str, settings: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """key, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every vector that is kept, and the codebooks.

    Vectors that are null or hold a component that is null or not finite are
    dropped.  The codebooks start from the vectors of the least keys (null
    keys last; of one key, the vectors in their order).  All rows count, also
    where keys or vectors repeat.  Vectors of another width than that of the
    first key, and all if that can't be cut into equal parts, keep their row
    with null code and error.  ``label_error`` adds up the errors of equal
    labels, null being one.  An empty table gives an empty one.  Components of
    2^26 or more after scaling stop the job.
    """
    numbers = whole_numbers(F.col(vector), settings.scale)
    taken = df.select(F.col(key).alias("_key"), F.col(label).alias("_label"), numbers.alias("_x")).filter("_x is not null")
    rows = stage(taken.withColumn("_row", F.monotonically_increasing_id()))  # lasting, as the rows are staged
    first = rows.orderBy(F.col("_key").asc_nulls_last(), "_x").limit(1).collect()
    width = len(first[0]["_x"]) if first else 0
    if not width or width % settings.parts:
        unknown = [F.lit(None).cast("string").alias("code"), *[F.lit(None).cast("long").alias(c) for c in ("error", "label_error")]]
        nothing = np.zeros((settings.parts, 0, 0), np.int64)
        return rows.select(F.col("_key").alias(key), *unknown, F.lit(digest(nothing)).alias("codebooks_sha256")), nothing
    fitting = rows.filter(F.size("_x") == width)
    start = fitting.orderBy(F.col("_key").asc_nulls_last(), "_x").limit(settings.entries).select("_x").collect()
    first = np.array([r["_x"] for r in start], np.int64)
    books = first.reshape(len(first), settings.parts, -1).transpose(1, 0, 2).copy()
    blocks = stage(_cut(fitting, first, settings))
    for _ in range(settings.rounds):
        books = _moved(blocks, books)
    each = [F.max(F.when(F.col("part") == p, F.col("entry"))) for p in range(settings.parts)]
    digits = max(2, len(f"{settings.entries - 1:x}"))
    code = F.concat(*[F.lower(F.lpad(F.hex(e), digits, "0")) for e in each])
    codes = _coded(blocks, books).groupBy("row").agg(code.alias("code"), F.sum("error").alias("error"))
    coded = stage(rows.select("_row", "_key", "_label").join(codes, F.col("_row") == F.col("row"), "left").drop("_row", "row"))
    by_label = coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    whole = coded.join(by_label, F.col("_label").eqNullSafe(F.col("_of")))
    return whole.select(F.col("_key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")), books
