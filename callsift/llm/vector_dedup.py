"""Near-duplicate vectors by randomised-rotation binary codes.

A random rotation turns each unit vector into a code of signs.  With the code
goes a correction factor, and the two give an unbiased estimate of an inner
product with a known error; only pairs whose upper confidence bound reaches
the threshold are computed exactly, in double precision.

Pairs to look at come from hash tables: each table keys a vector by some signs
of further rotations.  The number of signs follows the number of vectors, and
the number of tables follows from the signs and the wanted recall, so buckets
stay small at any size.  A bucket is cut into blocks that meet in pairs, so a
bucket of any size is dealt out over tasks.  Equal vectors are one class with
a count, so copies of one vector are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.blocks import in_blocks, starts_of, whole_groups
from callsift.llm.components import connected
from callsift.session import stage

#: Vectors and rotations are rounded to this part, so that sums of products are exact and signs repeatable.
GRID = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``miss``: chance that a pair at the threshold shares no table.  ``spread``: half width of the confidence
    interval in standard errors.  ``block``: vectors of a bucket that one group compares with as many."""

    threshold: float = 0.95
    miss: float = 1e-4
    spread: float = 5.0
    block: int = 1024
    seed: int = 5


def rotations(width: int, number: int, seed: int) -> np.ndarray:
    """``number`` random rotations side by side (width x number * width), on the grid."""
    draw = np.random.default_rng(seed)
    return np.hstack([np.linalg.qr(draw.standard_normal((width, width)))[0] for _ in range(number)])


def on_grid(x: np.ndarray) -> np.ndarray:
    return np.rint(x * GRID)


@dataclass(frozen=True)
class Tables:
    """How vectors of one width are keyed: ``signs`` of each of ``tables`` tables."""

    width: int
    signs: int
    tables: int
    seed: int

    @staticmethod
    def planned(width: int, vectors: int, settings: Settings) -> Tables:
        signs = min(60, max(4, math.ceil(math.log2(max(2, vectors))) + 4))
        same = 1 - math.acos(settings.threshold) / math.pi
        return Tables(width, signs, math.ceil(math.log(settings.miss) / math.log1p(-(same**signs))), settings.seed)

    def planes(self) -> np.ndarray:
        number = -(-self.signs * self.tables // max(1, self.width))
        return on_grid(rotations(self.width, number, self.seed + 1))[:, : self.signs * self.tables]

    def keys(self, unit: np.ndarray, planes: np.ndarray) -> np.ndarray:
        """vectors x tables keys."""
        bits = (on_grid(unit) @ planes > 0).reshape(len(unit), self.tables, self.signs)
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(self.signs, dtype=np.int64))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their codes of -1 and 1, and the correction factor: inner product of a vector with its scaled code."""
    turned = unit @ rotation
    code = np.where(turned > 0, 1.0, -1.0)
    return turned, code, (turned * code).sum(axis=1) / math.sqrt(unit.shape[1])


def upper_bounds(code: np.ndarray, factor: np.ndarray, turned: np.ndarray, spread: float) -> np.ndarray:
    """Upper confidence bound of the inner product of each coded vector with each rotated one.

    The estimate <code, q> / <code, vector> is unbiased; its standard error is
    sqrt((1 - f * f) / f * f / (width - 1)) with f the correction factor.
    """
    width = code.shape[1]
    estimate = (code @ turned.T) / math.sqrt(width) / factor[:, None]
    error = np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(1, width - 1))
    return estimate + spread * error[:, None]


class _Compare:
    """Compares the rows of a bucket, or of two of its blocks."""

    def __init__(self, plan: Tables, settings: Settings):
        self.plan, self.settings = plan, settings
        self.planes = plan.planes()
        self.rotation = rotations(plan.width, 1, plan.seed)

    def links(self, left: np.ndarray, right: np.ndarray, units: np.ndarray, coded) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs of two lists of rows, exact where the bound doesn't rule them out."""
        turned, code, factor = coded
        likely = upper_bounds(code[left], factor[left], turned[right], self.settings.spread) >= self.settings.threshold
        i, j = np.nonzero(likely)
        found = []
        for at in range(0, len(i), 1 << 18):
            p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            close = np.einsum("ij,ij->i", units[left[p]], units[right[q]]) >= self.settings.threshold
            found.append((left[p[close]], right[q[close]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near_vectors(df: DataFrame, key: str, vector: str, settings: Settings = Settings()) -> DataFrame:
    """key, ``n_links``, ``component_id`` and ``kept`` of every row.

    Links are pairs of different keys whose cosine reaches the threshold.
    Vectors that are null or zero, or hold nulls or numbers that are not
    finite, link with nothing, and vectors of different width never do.  Every
    row counts, also where keys repeat.  A row without a key has no links and
    no component and is kept.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x * x)
    usable = F.col(key).isNotNull() & (F.size(vector) > 0) & finite & (norm > 0)
    rows = stage(
        df.select(F.col(key).alias("_key"), F.when(F.coalesce(usable, F.lit(False)), numbers).alias("_vector"))
        .withColumn("_width", F.coalesce(F.size("_vector"), F.lit(0)))
        .withColumn("_row", F.monotonically_increasing_id())  # lasting, as the rows are staged
    )
    classes = _classes(rows)
    widths = classes.groupBy("_width").count().collect()  # a row for each width
    found = [_links_of_width(classes.filter(F.col("_width") == w["_width"]), w["_width"], w["count"], settings) for w in widths]
    if not found:
        return rows.select(F.col("_key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"), F.lit(True).alias("kept"))
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    both = stage(both)
    linked = both.groupBy(F.col("a").alias("_row")).agg(F.sum("n").alias("_n"))
    # rows of one class link with each other, unless they share their key
    known = classes.select("_row", "_least", "_owner", "_weight", *DIGEST).join(linked, "_row", "left")
    each = F.coalesce("_n", F.lit(0)) + F.when(F.col("_owner").isNull(), F.col("_weight") - 1).otherwise(F.lit(0))
    known = known.select("_least", "_owner", *DIGEST, each.alias("_each"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    # a class may hold a third of all rows, so they are dealt over parts
    salted = _with_owner(rows).select("_key", "_owner", *DIGEST, F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int").alias("_salt"))
    on = [F.col(c) == F.col(f"_of{c}") for c in (*DIGEST, "_salt")] + [F.col("_owner").eqNullSafe(F.col("_as"))]
    known = known.withColumnsRenamed({**{c: f"_of{c}" for c in (*DIGEST, "_salt")}, "_owner": "_as"})
    members = stage(salted.join(known, on).select("_key", "_least", "_each"))
    counted = members.groupBy(F.col("_key").alias("_at")).agg(F.sum("_each").alias("n_links"))
    names = classes.select("_row", "_least")
    ends = both.filter("b is not null").select("a", "b").distinct()
    ends = ends.join(names.select(F.col("_row").alias("a"), F.col("_least").alias("x")), "a")
    ends = ends.join(names.select(F.col("_row").alias("b"), F.col("_least").alias("y")), "b").select("x", "y")
    inside = members.select(F.col("_key").alias("x"), F.col("_least").alias("y"))
    groups = connected(ends.unionByName(inside), "x", "y")
    component = F.coalesce("component", "_key")
    return (
        rows.select("_key")
        .join(counted, F.col("_key") == F.col("_at"), "left")
        .join(groups, F.col("_key") == F.col("node"), "left")
        .select(
            F.col("_key").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept"),
        )
    )


#: 128 bits of a vector that tell it from others.
DIGEST = ("_one", "_two")
#: Parts that the rows of a class of equal vectors are dealt over.
SALTS = 16


def _with_owner(rows: DataFrame) -> DataFrame:
    """Usable rows with the digest of their vector, and as ``_owner`` their key if several rows have it."""
    usable = rows.filter("_vector is not null")
    repeated = usable.groupBy("_key").count().filter("count > 1").select(F.col("_key").alias("_owner"))
    digests = {name: F.xxhash64(F.lit(seed), "_vector") for seed, name in enumerate(DIGEST)}
    return usable.withColumns(digests).join(repeated, F.col("_key") == F.col("_owner"), "left")


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each vector, or for each vector and key where keys repeat: _row, _vector, _width, _weight, _least, _owner.

    ``_weight`` counts its rows and ``_least`` is their least key.  Equal
    vectors are compared with others once, however many there are.
    """
    alike = _with_owner(rows).groupBy(*DIGEST, "_owner").agg(F.min("_row").alias("_row"), F.count(F.lit(1)).alias("_weight"), F.min("_key").alias("_least"))
    return stage(alike.join(rows.select("_row", "_vector", "_width"), "_row"))


def _links_of_width(rows: DataFrame, width: int, vectors: int, settings: Settings) -> DataFrame:
    """(a, b, n): n links of class a found in one group, and b, a class linked with a (null if there is none to tell)."""
    plan = Tables.planned(width, vectors, settings)

    def to_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = plan.planes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = plan.keys(_unit(_matrix(part.column("_vector"), width)), planes)
                row = np.repeat(part.column("_row").to_numpy(), plan.tables)
                table = np.tile(np.arange(plan.tables, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(table), pa.array(keys.ravel())], names=["_row", "_table", "_hash"])

    # keys first, without vectors: most buckets hold a single row and end here
    keyed = stage(rows.mapInArrow(to_keys, "_row long, _table int, _hash long"))
    shared = keyed.groupBy("_table", "_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    meets = in_blocks(keyed.join(stage(shared), ["_table", "_hash"]), ["_table", "_hash"], "_row", "_n", settings.block)
    group = ["_table", "_hash", "_low", "_high"]
    full = meets.join(rows.select("_row", "_owner", "_weight", "_vector"), "_row")
    ordered = full.repartition(*group).sortWithinPartitions(*group, "_block", "_row")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Compare(plan, settings)
        for table in whole_groups(batches, group):
            yield from _compare_groups(table, group, worker)

    columns = ["_row", "_owner", "_weight", "_vector", "_block", *group]
    return ordered.select(*columns).mapInArrow(compare, "a long, b long, n long")


def _compare_groups(table: pa.Table, group: list[str], worker: _Compare) -> Iterator[pa.RecordBatch]:
    starts = np.append(starts_of(table, group), table.num_rows)
    vectors = table.column("_vector").combine_chunks()
    units = _unit(_matrix(vectors, worker.plan.width))
    coded = encode(units, worker.rotation)
    block = table.column("_block").to_numpy()
    low, high, number = (table.column(c).to_numpy() for c in ("_low", "_high", "_table"))
    names, weight = table.column("_row").to_numpy(), table.column("_weight").to_numpy()
    owners = np.asarray(table.column("_owner").to_pylist(), object)
    owned = np.array([o is not None for o in owners], bool)
    lefts, rights = [], []
    for start, end in zip(starts[:-1], starts[1:], strict=True):
        if end - start < 2:
            continue
        inside = np.arange(start, end)
        if low[start] == high[start]:
            left, right = worker.links(inside, inside, units, coded)
            keep = left < right
            left, right = left[keep], right[keep]
        else:
            left, right = worker.links(inside[block[inside] == low[start]], inside[block[inside] == high[start]], units, coded)
        lefts.append(left)
        rights.append(right)
    if not lefts:
        return
    left, right = np.concatenate(lefts), np.concatenate(rights)
    # a class of one repeated key has no links with others of that key
    other = names[left] != names[right]
    other &= ~(owned[left] & owned[right] & (owners[left] == owners[right]))
    left, right = left[other], right[other]
    if not len(left):
        return
    # a pair that meets in several tables counts in the first of them
    involved, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    keys = worker.plan.keys(units[involved], worker.planes)
    p, q = place[: len(left)], place[len(left) :]
    first = np.empty(len(left), bool)
    for at in range(0, len(left), 1 << 16):
        same = keys[p[at : at + (1 << 16)]] == keys[q[at : at + (1 << 16)]]
        first[at : at + (1 << 16)] = same.argmax(axis=1) == number[left[at : at + (1 << 16)]]
    links = np.zeros(table.num_rows, np.int64)
    np.add.at(links, left[first], weight[right[first]])
    np.add.at(links, right[first], weight[left[first]])
    # each row is tied to its least neighbour here, or its own name if that is less: this keeps the group connected
    # only if every link is followed, so neighbours are spread until nothing changes
    least = np.arange(table.num_rows)
    while True:
        before = least.copy()
        np.minimum.at(least, left, least[right])
        np.minimum.at(least, right, least[left])
        least = least[least]
        if (least == before).all():
            break
    tied = np.flatnonzero((least != np.arange(table.num_rows)) | (links > 0))
    joined = least[tied] != tied
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names[tied]),
            pa.array(np.where(joined, names[least[tied]], names[tied]), mask=~joined),
            pa.array(links[tied]),
        ],
        names=["a", "b", "n"],
    )
