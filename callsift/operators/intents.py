"""Distances between sentences and sets of reference sentences
(I1-I13, A7, A8, J11).

A small set of references travels inside the plan as one constant, and each
sentence is compared with all of it in place.  A larger one goes past the
encoded sentences block by block.  Nothing is paired up in a join, and a chunk
is not taken apart: its sub-sentences stay in an array next to it.

Vectors find their least distance to a table of references of any size by
metric pruning (``least_distances``).  Where only that is asked of chunks, their
distinct sub-sentences become such rows.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.functions.text import sub_sentences
from callsift.functions.vectors import distances_to
from callsift.operators.ordering import number_rows
from callsift.session import release_shuffles, stage, unstage

# a batch encoder is built once per Python worker and maps texts to a matrix
BatchEncoder = Callable[[list[str]], np.ndarray]
# a column encoder is an expression from text to array<double>
ColumnEncoder = Callable[[Column], Column]

# reference values that may stand in a plan as a constant
MAX_PLAN_VALUES = 500_000
# reference values that a task holds at once; more come one block after the other
BLOCK_VALUES = 5_000_000
# distances that go out in one batch, and those that a task works out in one pass over the references
OUT_VALUES = 2_000_000
PASS_VALUES = 24_000_000

# intent, number of the block's first reference, matrix, one over the lengths of its rows
Block = tuple[str, int, np.ndarray, np.ndarray]


def _unit_rows(rows) -> np.ndarray:
    matrix = np.asarray(rows, dtype="float64")
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


@dataclass(frozen=True)
class IntentPack:
    """Reference vectors of one or several intents, at unit length.

    ``vectors[intent]`` is a matrix with a row per reference sentence.
    """

    vectors: Mapping[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def of(vectors: Mapping[str, Sequence[Sequence[float]]]) -> IntentPack:
        return IntentPack({intent: _unit_rows(rows) for intent, rows in vectors.items()})

    @staticmethod
    def encode(sentences: Mapping[str, Sequence[str]], encoder: BatchEncoder) -> IntentPack:
        return IntentPack.of({k: encoder(list(v)) for k, v in sentences.items()})

    @staticmethod
    def from_rows(rows: DataFrame, intent: str, order: str, vector: str) -> IntentPack | StoredPack:
        """A pack kept as a table.  One that is too large for a plan stays a table."""
        stored = StoredPack(rows, intent, order, vector)
        if stored.values() > MAX_PLAN_VALUES:
            return stored
        found: dict[str, list] = {}
        for row in rows.orderBy(intent, order).select(intent, vector).collect():
            found.setdefault(str(row[0]), []).append(row[1])
        return IntentPack.of(found)

    def sizes(self) -> dict[str, int]:
        """References per intent."""
        return {k: int(v.shape[0]) for k, v in self.vectors.items()}

    def values(self) -> int:
        return sum(int(np.asarray(v).size) for v in self.vectors.values())

    def references(self, spark: SparkSession, intent: str) -> DataFrame:
        """``(j, vec)`` of an intent."""
        matrix = np.asarray(self.vectors[intent], dtype="float64")
        return spark.createDataFrame(pa.table({"j": pa.array(np.arange(len(matrix))), "vec": _lists_of(matrix)}))

    def blocks(self, values: int) -> Iterator[Block]:
        for intent, matrix in self.vectors.items():
            rows = max(1, values // max(1, matrix.shape[1]))
            for at in range(0, len(matrix), rows):
                part = np.asarray(matrix[at : at + rows], dtype="float64")
                yield intent, at, part, np.ones(len(part))

    def literal(self, intent: str) -> Column:
        return F.expr(
            f"from_json('{json.dumps(self.vectors[intent].tolist())}', 'array<array<double>>')"
        )


class StoredPack:
    """Reference vectors of any number, kept as a table: intent, order, vector.

    The driver sees one block of them at a time, and none where only least
    distances are asked for.
    """

    def __init__(self, rows: DataFrame, intent: str, order: str, vector: str):
        # numbers of single precision stay so in the tables and blocks, and are worked with in double precision
        single = rows.schema[vector].dataType == T.ArrayType(T.FloatType(), rows.schema[vector].dataType.containsNull)
        kept = F.col(vector) if single else F.col(vector).cast("array<double>")
        named = rows.select(F.col(intent).cast("string").alias("intent"), F.col(order).alias("order"), kept.alias("vector"))
        self._rows, self._numbered = stage(named), None
        found = self._rows.groupBy("intent").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).collect()
        self._shapes = {r["intent"]: (r["n"], r["width"]) for r in sorted(found)}

    def sizes(self) -> dict[str, int]:
        """References per intent."""
        return {k: n for k, (n, _) in self._shapes.items()}

    def values(self) -> int:
        return sum(n * width for n, width in self._shapes.values())

    def references(self, spark: SparkSession, intent: str) -> DataFrame:
        """``(j, vec)`` of an intent."""
        return self._rows.filter(F.col("intent") == intent).select(F.col("order").alias("j"), F.col("vector").cast("array<double>").alias("vec"))

    def blocks(self, values: int) -> Iterator[Block]:
        if self._numbered is None:
            numbered = number_rows(self._rows, "intent", ["order"], "at", large_keys=True)
            # sorted, so that a block is read from its own row groups
            self._numbered = stage(numbered.repartitionByRange("intent", "at").sortWithinPartitions("intent", "at"))
        for intent, (n, width) in self._shapes.items():
            rows = max(1, values // max(1, width))
            for at in range(0, n, rows):
                some = self._numbered.filter((F.col("intent") == intent) & F.col("at").between(at, at + rows - 1))
                found = some.select("at", "vector").toArrow().sort_by("at").column("vector").combine_chunks()  # one block
                matrix = _batch_matrix(found, width)
                length = np.linalg.norm(matrix.astype("float64"), axis=1)
                yield intent, at, matrix, np.divide(1.0, length, out=np.zeros_like(length), where=length > 0)


Pack = IntentPack | StoredPack


@dataclass(frozen=True)
class OpposedPack:
    """Two packs of equal shape: a reference and its opposite."""

    positive: Pack
    negative: Pack

    @staticmethod
    def encode(pairs: Mapping[str, Sequence[str]], encoder: BatchEncoder) -> OpposedPack:
        """Pairs are written ``left/right``."""
        sides = {k: [p.split("/") for p in v] for k, v in pairs.items()}
        return OpposedPack(
            IntentPack.encode({k: [p[0] for p in v] for k, v in sides.items()}, encoder),
            IntentPack.encode({k: [p[1] for p in v] for k, v in sides.items()}, encoder),
        )

    def sizes(self) -> dict[str, int]:
        return self.positive.sizes()


def opposed_score(positive: Column, negative: Column) -> Column:
    """0 is close to the reference, 1 is close to its opposite."""
    return (F.lit(1.0) + positive - negative) / 2


# --- distances of vectors that are already rows --------------------------------


def with_distances(rows: DataFrame, vector: str, packs: Mapping[str, IntentPack]) -> DataFrame:
    """I2 over rows: a column ``<pack>_<intent>`` with all distances.

    The matrix product runs on whole Arrow batches; rows keep their place.
    """
    for name, pack in packs.items():
        for intent, matrix in pack.vectors.items():
            rows = rows.withColumn(f"{name}_{intent}", _distance_udf(matrix)(F.col(vector)))
    return rows


def _distance_udf(matrix: np.ndarray):
    unit = np.ascontiguousarray(matrix.T)

    @F.pandas_udf("array<double>")
    def distances(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        block = np.stack([np.asarray(v, dtype="float64") for v in vectors])
        return pd.Series(list(_cosine(block, unit)))

    return distances


def _cosine(block: np.ndarray, unit: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(block, axis=1, keepdims=True)
    scaled = np.divide(block, length, out=np.zeros_like(block), where=length > 0)
    return np.clip(1.0 - scaled @ unit, 0.0, 2.0)


def min_distance(
    scored: DataFrame, keys: Sequence[str], distances: str, chunks: DataFrame | None = None
) -> DataFrame:
    """Least distance per chunk over its sub-sentences and all references.

    ``chunks`` lists the chunks that must appear; one without sub-sentences
    gets 1.
    """
    least = scored.groupBy(*keys).agg(F.min(F.array_min(distances)).alias("dist"))
    return _complete(least, keys, chunks, ["dist"])


def all_distances(
    scored: DataFrame,
    keys: Sequence[str],
    distances: str,
    n: int,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Least distance per chunk and reference, as an array of ``n``.

    One minimum per reference, so the map tasks combine sub-sentences and no
    row is multiplied.
    """
    mins = scored.groupBy(*keys).agg(
        *[F.min(F.col(distances)[j]).alias(f"_{j}") for j in range(n)]
    )
    whole = _complete(mins, keys, chunks, [f"_{j}" for j in range(n)])
    return whole.select(*keys, F.array(*[F.col(f"_{j}") for j in range(n)]).alias("dists"))


def _named(name: str, intent: str, j: int) -> str:
    return f"_{name}_{intent}_{j}"


def _chunk_minima(scored, keys, packs, chunks):
    """All minima of all packs and intents in one aggregation."""
    columns = [
        (f"{name}_{intent}", j, _named(name, intent, j))
        for name, pack in packs.items()
        for intent, n in pack.sizes().items()
        for j in range(n)
    ]
    mins = scored.groupBy(*keys).agg(*[F.min(F.col(c)[j]).alias(out) for c, j, out in columns])
    return _complete(mins, keys, chunks, [out for _, _, out in columns])


def all_distances_by_intent(
    scored: DataFrame,
    keys: Sequence[str],
    name: str,
    pack: IntentPack,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """I4, I6 over rows: one array per intent and chunk."""
    whole = _chunk_minima(scored, keys, {name: pack}, chunks)
    return whole.select(
        *keys,
        *[
            F.array(*[F.col(_named(name, i, j)) for j in range(n)]).alias(i)
            for i, n in pack.sizes().items()
        ],
    )


def opposed_by_intent(
    scored: DataFrame,
    keys: Sequence[str],
    pack: OpposedPack,
    chunks: DataFrame | None = None,
    how: str = "all",
) -> DataFrame:
    """I7-I10 over rows that hold ``p_<intent>`` and ``n_<intent>`` distances."""
    whole = _chunk_minima(scored, keys, {"p": pack.positive, "n": pack.negative}, chunks)
    out = []
    for i, n in pack.sizes().items():
        pos = [F.col(_named("p", i, j)) for j in range(n)]
        neg = [F.col(_named("n", i, j)) for j in range(n)]
        if how == "all":
            score = F.array(*[opposed_score(a, b) for a, b in zip(pos, neg, strict=True)])
        else:
            score = opposed_score(F.array_min(F.array(*pos)), F.array_min(F.array(*neg)))
        out.append(score.alias(i))
    return whole.select(*keys, *out)


def min_distances_by_intent(
    scored: DataFrame,
    keys: Sequence[str],
    name: str,
    pack: IntentPack,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """I3, I5 over rows: the least distance per intent and chunk."""
    mins = scored.groupBy(*keys).agg(
        *[F.min(F.array_min(f"{name}_{i}")).alias(i) for i in pack.vectors]
    )
    return _complete(mins, keys, chunks, list(pack.vectors))


def _complete(df, keys, chunks, columns):
    if chunks is not None:
        df = chunks.join(df, list(keys), "left")
    return df.select(
        *keys, *[F.coalesce(F.col(c), F.lit(1.0)).alias(c) for c in columns]
    )


#: Values of the pivots that every task holds, and references and values of a cell of neighbouring clusters.
PIVOT_VALUES = 4_000_000
CLUSTER_BLOCK = 16_000
CELL_VALUES = 6_000_000
#: Rows of a part that meets a cell of references, and copies of rows in a batch on their way there.
PART_ROWS = 20_000
COPIES = 4_000
#: Values of rows and references that are sent to cells at once; more go in rounds.
ROUND_VALUES = 400_000_000
#: Angles are told apart by more than this; it makes up for rounding in cosines near 1.
SLACK = 1e-6


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & (F.size(vector) > 0), F.lit(False))


def least_distances(
    rows: DataFrame,
    vector: str,
    references: DataFrame,
    order: str = "j",
    reference_vector: str = "vec",
    pivots: int | None = None,
) -> DataFrame:
    """I2, A7, J11 against a table of references of any number: the exact least distance, without all pairs.

    Some references are pivots, and each reference belongs to the pivot at the
    least angle.  Angles obey the triangle inequality, so a row compares
    itself with the pivots first; the nearest one bounds its least angle, and
    only clusters whose radius reaches within that bound are opened.  In a
    cluster only references at an angle to the pivot that the bound allows are
    multiplied.  Neighbouring clusters form cells, and a large cluster several.
    A row is sent once to each cell where a cluster is open to it, so where
    nothing can be pruned its copies grow with the references over the size of
    a cell, not with the pivots.  Rows meet cells in tasks, in parts, however
    many rows open them.  Copies of ``ROUND_VALUES`` values are on their way at
    once: more cells take several rounds, and what one has exchanged is deleted
    before the next.

    Adds ``dist``, ``nearest`` (order of the nearest reference, the least of
    those at one distance), ``seen`` (references that were compared or ruled
    out) and ``multiplied`` (products made).  A vector of zeros is at distance
    1.  References that are null, empty or hold anything but finite numbers,
    or whose width is not that of the least order, are left out; such a row
    has null in all added columns, and so has every row without references.
    """
    given = references.select(F.col(order).alias("_order"), F.col(reference_vector).cast("array<double>").alias("_unit"))
    held = stage(given.filter(_usable(F.col("_unit"))))
    first = held.orderBy("_order").select(F.size("_unit").alias("width"), "_order").first()
    added, kinds = ["dist", "nearest", "seen", "multiplied"], held.schema["_order"].dataType
    if first is None:
        nothing = {"dist": "double", "nearest": kinds, "seen": "long", "multiplied": "long"}
        return rows.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    width = first["width"]
    held = held.filter(F.size("_unit") == width)
    zero = F.aggregate("_unit", F.lit(0.0), lambda a, x: a + x * x) == 0
    total, zeros, least_zero = held.agg(F.count(F.lit(1)), F.count_if(zero), F.min(F.when(zero, F.col("_order")))).first()
    some = pivots or int(2 * np.sqrt(total)) + 1
    chosen = held.filter(~zero).orderBy(F.xxhash64("_order"), "_order").limit(max(1, min(some, PIVOT_VALUES // width)))
    points = _unit_rows([r["_unit"] for r in chosen.select("_unit").collect()]).reshape(-1, width)
    kept = stage(rows.drop(*added).withColumn("_row", F.monotonically_increasing_id()))  # lasting, as the rows are staged
    numbers = F.col(vector).cast("array<double>")
    asked = kept.filter(_usable(numbers) & (F.size(vector) == width)).select("_row", numbers.alias("_unit"))
    is_zero = F.aggregate("_unit", F.lit(0.0), lambda a, x: a + x * x) == 0
    # zeros are at distance 1 from everything
    plain = asked.filter(is_zero).select("_row", F.lit(1.0).alias("dist"), F.lit(first["_order"]).cast(kinds).alias("nearest"))
    found = plain.select("*", F.lit(total).cast("long").alias("seen"), F.lit(0).cast("long").alias("multiplied"))
    if len(points):
        members = stage(_assigned(held.filter(~zero), points, width))
        unstage(held)
        found = found.unionByName(_nearest(asked.filter(~is_zero), members, points, width, kinds, zeros, least_zero))
    elif total:
        found = asked.select("_row", F.lit(1.0).alias("dist"), F.lit(first["_order"]).cast(kinds).alias("nearest"), F.lit(total).cast("long").alias("seen"), F.lit(0).cast("long").alias("multiplied"))
    found = found.withColumnRenamed("_row", "_of")
    return kept.join(found, F.col("_row") == F.col("_of"), "left").drop("_row", "_of")


def _angles(unit: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ points.T, -1.0, 1.0))


def _batch_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists_of(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _assigned(held: DataFrame, points: np.ndarray, width: int) -> DataFrame:
    """References with the number of their pivot and the angle to it, at unit length."""
    shared = held.sparkSession.sparkContext.broadcast(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                unit = _unit_rows(_batch_matrix(part.column("_unit"), width))
                angles = _angles(unit, shared.value)
                own = angles.argmin(axis=1)
                columns = [pa.array(own.astype(np.int32)), pa.array(angles[np.arange(len(own)), own]), part.column("_order"), _lists_of(unit)]
                yield pa.RecordBatch.from_arrays(columns, names=["_cluster", "_angle", "_order", "_unit"])

    schema = T.StructType([T.StructField("_cluster", T.IntegerType()), T.StructField("_angle", T.DoubleType()), held.schema["_order"], T.StructField("_unit", T.ArrayType(T.DoubleType()))])
    return held.select("_order", "_unit").mapInArrow(run, schema)


def _by_halves(points: np.ndarray, some: np.ndarray) -> list[int]:
    """Pivots in an order that keeps neighbours together: halves along the line to a far one, and so on in each."""
    if len(some) <= 2:
        return some.tolist()
    here = points[some]
    along = here @ (here[(here @ here[0]).argmin()] - here[0])
    order = some[np.argsort(along, kind="stable")]
    middle = len(order) // 2
    return _by_halves(points, order[:middle]) + _by_halves(points, order[middle:])


def _cells(points: np.ndarray, sizes: np.ndarray, most: int) -> tuple[list[list[int]], np.ndarray]:
    """Groups of neighbouring clusters with at most ``most`` references, and the cells of each: a larger cluster is cut."""
    groups: list[list[int]] = []
    held = most
    for cluster in _by_halves(points, np.flatnonzero(sizes)):
        if held + sizes[cluster] > most:
            groups.append([])
            held = 0
        groups[-1].append(cluster)
        held += int(sizes[cluster])
    return groups, np.array([-(-int(sizes[g].sum()) // most) if len(g) == 1 else 1 for g in groups], np.int64)


def _nearest(asked: DataFrame, members: DataFrame, points: np.ndarray, width: int, kind, zeros: int, least_zero) -> DataFrame:
    """(_row, dist, nearest, seen, multiplied) of rows that are no zeros."""
    spark = asked.sparkSession
    sizes, radius = np.zeros(len(points), np.int64), np.full(len(points), -np.inf)
    for r in members.groupBy("_cluster").agg(F.count(F.lit(1)).alias("n"), F.max("_angle").alias("r")).collect():  # a row for each pivot
        sizes[r["_cluster"]], radius[r["_cluster"]] = r["n"], r["r"]
    groups, cells = _cells(points, sizes, max(1, min(CLUSTER_BLOCK, CELL_VALUES // width)))
    order, starts = np.concatenate(groups).astype(int), np.cumsum([0, *map(len, groups)])[:-1]
    totals, base = np.array([sizes[g].sum() for g in groups]), np.cumsum(cells) - cells
    shared = spark.sparkContext.broadcast((points, radius, order, starts, totals, base, cells))

    def opened(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        points, radius, order, starts, totals, base, cells = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                unit = _unit_rows(_batch_matrix(part.column("_unit"), width))
                angles = _angles(unit, points)
                own, bound = angles.argmin(axis=1), angles.min(axis=1) + SLACK
                hit = np.logical_or.reduceat((angles - radius[None, :] <= bound[:, None])[:, order], starts, axis=1)
                if wanted is None:
                    asked_of = np.repeat(hit.sum(axis=0), cells)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked_of), dtype=np.int32)), pa.array(asked_of.astype(np.int64))], names=["_cell", "n"])
                    continue
                row, group = np.nonzero(hit)
                closed = totals.sum() - hit @ totals
                first = np.append(True, row[1:] != row[:-1])
                times = cells[group]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, cell, first = np.repeat(row, times), np.repeat(base[group], times) + within, np.repeat(first, times) & (within == 0)
                now = wanted[cell]
                row, cell, first = row[now], cell[now], first[now]
                for a in range(0, len(row), COPIES):
                    some = row[a : a + COPIES]
                    columns = {
                        "_cell": pa.array(cell[a : a + COPIES].astype(np.int32)),
                        "_id": part.column("_row").take(pa.array(some)),
                        "_cluster": pa.array(own[some].astype(np.int32)),
                        "_bound": pa.array(bound[some]),
                        # told once for each row
                        "_closed": pa.array(np.where(first[a : a + COPIES], closed[some], 0)),
                        "_unit": _lists_of(unit[some]),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    counted = asked.mapInArrow(opened, "_cell int, n long")
    opens = counted.groupBy("_cell").agg(F.sum("n").alias("n")).filter("n > 0").orderBy("_cell").collect()  # a row for each cell
    dealt_to = {r["_cell"]: -(-r["n"] // PART_ROWS) for r in opens}
    held_by = np.repeat(-(-totals // cells), cells)
    load = np.array([(r["n"] + dealt_to[r["_cell"]] * held_by[r["_cell"]]) * width for r in opens], np.int64)
    group = ["_cell", "_part"]
    # a row for each pivot
    places = [(c, int(b), int(n)) for g, b, n in zip(groups, base, cells, strict=True) for c in g]
    cut = members.join(F.broadcast(spark.createDataFrame(places, "_cluster int, _base int, _cells int")), "_cluster")
    cut = cut.withColumn("_cell", (F.col("_base") + F.pmod(F.xxhash64("_order", F.lit(5)), "_cells")).cast("int"))
    no_number = [F.lit(None).cast("double").alias("_bound"), F.lit(None).cast("long").alias("_closed"), F.lit(None).cast("long").alias("_id")]

    def met(some: list[int]) -> DataFrame:
        """Rows and references of some cells; rows of one nearest pivot come one after the other."""
        wanted = np.zeros(cells.sum(), bool)
        wanted[some] = True
        # a row for each cell, so that no vector is exchanged to be told its parts
        parts = F.broadcast(spark.createDataFrame([(c, dealt_to[c]) for c in some], "_cell int, _parts int"))
        sent = "_cell int, _id long, _cluster int, _bound double, _closed long, _unit array<double>"
        questions = asked.mapInArrow(lambda batches: opened(batches, wanted), sent)
        dealt = questions.join(parts, "_cell").withColumn("_part", F.pmod(F.xxhash64("_id"), "_parts").cast("int"))
        left = dealt.select(*group, F.lit(1).alias("_side"), "_cluster", F.lit(None).cast("double").alias("_angle"), "_bound", "_closed", "_id", F.lit(None).cast(kind).alias("_order"), "_unit")
        asked_for = cut.join(parts, "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        right = asked_for.select(*group, F.lit(0).alias("_side"), "_cluster", "_angle", *no_number, "_order", "_unit")
        return right.unionByName(left).repartition(*group).sortWithinPartitions(*group, "_side", "_cluster")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, now, held = shared.value[0], None, []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in (*group, "_side")], axis=1)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(marks)], strict=True):
                part, where, side = batch.slice(a, b - a), tuple(marks[a, :2]), marks[a, 2]
                if where != now:
                    now, held = where, []
                if side == 0:
                    held.append(part.select(["_cluster", "_angle", "_order", "_unit"]))
                else:
                    if isinstance(held, list):
                        # a cell of a cut cluster may have got no reference
                        held = _Cell(pa.Table.from_batches(held, schema=part.select(["_cluster", "_angle", "_order", "_unit"]).schema), points, width)
                    for at in range(0, part.num_rows, 256):
                        yield from held.compared(part.slice(at, 256))

    out = T.StructType([T.StructField("_row", T.LongType()), T.StructField("dist", T.DoubleType()), T.StructField("nearest", kind), T.StructField("seen", T.LongType()), T.StructField("multiplied", T.LongType())])
    rounds = (np.cumsum(load) - load) // ROUND_VALUES
    told = []
    for number in np.unique(rounds):
        said = met([r["_cell"] for r, n in zip(opens, rounds, strict=True) if n == number]).mapInArrow(compare, out)
        told.append(said if rounds[-1] == rounds[0] else stage(said))
        if told[-1] is not said:
            del said
            release_shuffles(spark)
    answers = functools.reduce(DataFrame.unionByName, told or [spark.createDataFrame([], out)]).groupBy("_row")
    answers = answers.agg(F.min(F.struct("dist", "nearest")).alias("_best"), F.sum("seen").alias("seen"), F.sum("multiplied").alias("multiplied"))
    best = F.col("_best")
    if zeros:
        best = F.least(best, F.struct(F.lit(1.0).alias("dist"), F.lit(least_zero).cast(kind).alias("nearest")))
    return answers.select("_row", best["dist"].alias("dist"), best["nearest"].alias("nearest"), (F.col("seen") + zeros).alias("seen"), "multiplied")


class _Cell:
    """References of a cell, in their order, so that the first of several at one distance is the least."""

    def __init__(self, held: pa.Table, points: np.ndarray, width: int):
        held = held.take(pa.compute.sort_indices(held.column("_order")))
        self.width, self.orders = width, held.column("_order").combine_chunks()
        self.matrix = _batch_matrix(held.column("_unit").combine_chunks(), width)
        self.angle = held.column("_angle").to_numpy()
        known, self.cluster, self.sizes = np.unique(held.column("_cluster").to_numpy(), return_inverse=True, return_counts=True)
        self.points = points[known.astype(int)]

    def compared(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows against those references that their bounds allow; all of a batch at once, or those of one pivot."""
        unit, bound = _batch_matrix(part.column("_unit"), self.width), part.column("_bound").to_numpy()[:, None]
        angles = _angles(unit, self.points)
        low, high = angles - bound, angles + bound
        radius = np.full(len(self.sizes), -np.inf)
        np.maximum.at(radius, self.cluster, self.angle)
        cuts = [0, part.num_rows]
        if ((low <= radius) @ self.sizes).mean() < len(self.angle) / 2:
            own = part.column("_cluster").to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1), part.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            allowed = (self.angle >= low[a:b].min(axis=0)[self.cluster] - SLACK) & (self.angle <= high[a:b].max(axis=0)[self.cluster] + SLACK)
            yield self._multiplied(part.slice(a, b - a), unit[a:b], allowed)

    def _multiplied(self, part: pa.RecordBatch, unit: np.ndarray, allowed: np.ndarray) -> pa.RecordBatch:
        places = np.flatnonzero(allowed)
        if len(places):
            there = self.matrix if len(places) == len(allowed) else self.matrix[places]
            far = np.clip(1.0 - unit @ there.T, 0.0, 2.0)
            nearest = far.argmin(axis=1)
            dist, order = pa.array(far[np.arange(len(far)), nearest]), self.orders.take(pa.array(places[nearest]))
        else:
            # beyond all distances: some other cell has the nearest
            dist, order = pa.array(np.full(part.num_rows, 3.0)), pa.nulls(part.num_rows, self.orders.type)
        seen = len(self.angle) + part.column("_closed").to_numpy()
        columns = [part.column("_id"), dist, order, pa.array(seen), pa.array(np.full(part.num_rows, len(places), np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["_row", "dist", "nearest", "seen", "multiplied"])


# --- distances of chunks of text -------------------------------------------------


def _least_by_reference(vectors: str, unit: Column, n: int) -> Column:
    """Least distance of any vector to each reference; ones without vectors."""
    found = F.aggregate(
        vectors,
        F.array_repeat(F.lit(2.0), n),
        lambda acc, v: F.zip_with(acc, distances_to(v, unit), lambda a, b: F.least(a, b)),
    )
    return F.when(F.size(vectors) > 0, found).otherwise(F.array_repeat(F.lit(1.0), n))


def _by_column(
    df: DataFrame, subs: Column, encoder: ColumnEncoder, packs: Mapping[str, IntentPack]
) -> DataFrame:
    """Encode and compare in the JVM, inside the row."""
    vectors = df.withColumn("_vectors", F.transform(subs, encoder))
    for name, pack in packs.items():
        for intent, matrix in pack.vectors.items():
            vectors = vectors.withColumn(
                f"{name}_{intent}",
                _least_by_reference("_vectors", pack.literal(intent), matrix.shape[0]),
            )
    return vectors.drop("_vectors")


def _by_batch(
    df: DataFrame,
    subs: Column,
    encoder: Callable[[], BatchEncoder],
    packs: Mapping[str, IntentPack],
) -> DataFrame:
    """Encode whole Arrow batches, each distinct sentence once, and keep only
    the distances."""
    names = [(n, i) for n, p in packs.items() for i in p.vectors]
    units = [np.ascontiguousarray(packs[n].vectors[i].T) for n, i in names]
    schema = "struct<" + ",".join(f"`{n}_{i}`:array<double>" for n, i in names) + ">"

    @F.pandas_udf(schema)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for lists in batches:
            counts = lists.map(len).to_numpy()
            texts = np.array([t for ts in lists for t in ts], dtype=object)
            columns = {}
            if len(texts):
                distinct, back = np.unique(texts, return_inverse=True)
                block = np.asarray(encode(list(distinct)), dtype="float64")
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("int64")
            for (name, intent), unit in zip(names, units, strict=True):
                out = np.ones((len(lists), unit.shape[1]))
                filled = counts > 0
                if filled.any():
                    rows = _cosine(block, unit)[back]
                    out[filled] = np.minimum.reduceat(rows, starts[filled], axis=0)
                columns[f"{name}_{intent}"] = list(out)
            yield pd.DataFrame(columns)

    scored = df.withColumn("_scored", score(subs))
    return scored.select(*df.columns, *[F.col("_scored")[f"{n}_{i}"].alias(f"{n}_{i}") for n, i in names])


def _encoded(df: DataFrame, subs: Column, column_encoder, batch_encoder) -> DataFrame:
    """``df`` with ``_n``, the number of sub-sentences of a chunk, and ``_flat``, their vectors one behind the other."""
    listed = df.withColumn("_subs", subs)
    if column_encoder is not None:
        vectors = F.flatten(F.transform("_subs", column_encoder)).cast("array<double>")
        return listed.withColumns({"_n": F.size("_subs"), "_flat": vectors}).drop("_subs")

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = batch_encoder()
        for lists in batches:
            texts = np.array([t for ts in lists for t in ts], dtype=object)
            ends = np.cumsum(lists.map(len).to_numpy())
            if len(texts):
                distinct, back = np.unique(texts, return_inverse=True)
                rows = np.asarray(model(list(distinct)), dtype="float64")[back]
            else:
                rows = np.zeros((0, 0))
            yield pd.Series([x.ravel() for x in np.split(rows, ends[:-1])] if len(lists) else [], dtype=object)

    return listed.withColumns({"_n": F.size("_subs"), "_flat": encode("_subs")}).drop("_subs")


def _past_blocks(rows: DataFrame, packs: Mapping[str, Pack]) -> DataFrame:
    """All distances of encoded chunks (``_n``, ``_flat``) to packs of any size.

    Every block of references is a broadcast of its own.  A task takes as many
    chunks as ``PASS_VALUES`` distances past one block after the other and lets
    go of each, so it holds one block, a block is read once for all of them, and
    nothing is written on the way.  Chunks of a batch with the same vectors are
    worked out once.  Rows of a batch may change their order.
    """
    sizes = {f"{name}_{i}": n for name, pack in packs.items() for i, n in pack.sizes().items()}
    context = rows.sparkSession.sparkContext
    shared = [(f"{name}_{i}", first, context.broadcast(block)) for name, pack in packs.items() for i, first, *block in pack.blocks(BLOCK_VALUES)]
    total = max(1, sum(sizes.values()))
    step, most = max(1, PASS_VALUES // total), max(1, min(200, OUT_VALUES // total))
    kept = [c for c in rows.columns if c not in ("_n", "_flat", *sizes)]

    def passed(vectors: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Least distances of some chunks, each with its vectors, to all references."""
        out = {c: np.ones((len(vectors), n)) for c, n in sizes.items()}
        filled = np.flatnonzero([len(v) for v in vectors])
        if len(filled):
            counts = np.array([len(vectors[i]) for i in filled])
            starts = np.cumsum(counts) - counts
            unit = _unit_rows(np.concatenate([vectors[i] for i in filled]))
            for column, first, block in shared:
                matrix, scale = block.value
                # some references at a time, so that the products stay small beside them
                for a in range(0, len(matrix), 1000):
                    far = unit @ matrix[a : a + 1000].astype("float64", copy=False).T
                    far *= -scale[a : a + 1000]
                    far += 1.0
                    np.clip(far, 0.0, 2.0, out=far)
                    out[column][filled, first + a : first + a + far.shape[1]] = far if len(counts) == len(far) else np.minimum.reduceat(far, starts, axis=0)
                if len(shared) > 1:
                    vars(block).pop("_value", None)  # read again from the worker's copy when it is next asked for
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("_n").to_numpy().astype(np.int64)
            flat = batch.column("_flat").flatten().to_numpy(zero_copy_only=False)
            width = len(flat) // max(1, counts.sum())
            ends = np.cumsum(counts) * width
            number: dict[bytes, int] = {}
            alike = np.array([number.setdefault(flat[end - n * width : end].tobytes(), len(number)) for n, end in zip(counts, ends, strict=True)], np.int64)
            order = np.argsort(alike, kind="stable")
            first = np.searchsorted(alike[order], np.arange(len(number) + 1))
            for at in range(0, len(number), step):
                stop = min(at + step, len(number))
                ones = [order[i] for i in first[at:stop]]
                found = passed([flat[ends[i] - counts[i] * width : ends[i]].reshape(counts[i], -1) if counts[i] else np.zeros((0, 0)) for i in ones])
                mine = order[first[at] : first[stop]]
                for a in range(0, len(mine), most):
                    some = mine[a : a + most]
                    part = batch.take(pa.array(some))
                    columns = [part.column(c) for c in kept] + [_lists_of(x[alike[some] - at]) for x in found.values()]
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, *found])

    added = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in sizes])
    return rows.mapInArrow(run, T.StructType(rows.select(*kept).schema.fields + added.fields))


def _least_of_texts(df: DataFrame, subs: Column, column_encoder, batch_encoder, packs: Mapping[str, Pack]) -> DataFrame:
    """Least distances of chunks to each intent of packs of any size, as arrays of one.

    Sub-sentences become rows, each distinct one is encoded once in the whole
    job and finds its least distance as any vector does (``least_distances``).
    """
    spark = df.sparkSession
    columns = [f"{name}_{i}" for name, pack in packs.items() for i in pack.sizes()]
    kept = stage(df.drop(*columns).withColumn("_chunk", F.monotonically_increasing_id()))  # lasting, as the rows are staged
    said = kept.select("_chunk", F.explode(subs).alias("_text"))

    if column_encoder is None:

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = batch_encoder()
            for texts in batches:
                yield pd.Series(list(np.asarray(model(texts.tolist()), dtype="float64")) if len(texts) else [], dtype=object)

    else:
        encode = column_encoder

    found = stage(said.select("_text").distinct().withColumn("_vec", encode(F.col("_text"))))
    for name, pack in packs.items():
        for i in pack.sizes():
            found = least_distances(found, "_vec", pack.references(spark, i)).withColumnRenamed("dist", f"{name}_{i}").drop("nearest", "seen", "multiplied")
    least = said.join(found.drop("_vec"), "_text").groupBy(F.col("_chunk").alias("_of")).agg(*[F.min(c).alias(c) for c in columns])
    whole = kept.join(least, F.col("_chunk") == F.col("_of"), "left")
    return whole.select(*[c for c in kept.columns if c != "_chunk"], *[F.array(F.coalesce(c, F.lit(1.0))).alias(c) for c in columns])


def chunk_distances(
    chunks: DataFrame,
    text: str,
    packs: Mapping[str, Pack],
    column_encoder: ColumnEncoder | None = None,
    batch_encoder: Callable[[], BatchEncoder] | None = None,
    separator: str | None = None,
    least: bool = False,
) -> DataFrame:
    """I1 with I4/I6: distances of every chunk to every reference.

    Adds ``<pack>_<intent>`` columns, arrays of all distances; with ``least``
    an array may hold the least one alone.  Exactly one encoder is needed: an
    expression, or a factory of a function on lists of texts that is called
    once in each Python worker.  Packs may have any size: small ones are
    constants of the plan.  Sentences are encoded once and go past larger ones
    block by block, or, with ``least``, are looked up by ``least_distances``.
    """
    if (column_encoder is None) == (batch_encoder is None):
        raise ValueError("give a column encoder or a batch encoder")
    subs = (
        sub_sentences(F.col(text))
        if separator is None
        else sub_sentences(F.col(text), separator)
    )
    in_plan = all(isinstance(p, IntentPack) for p in packs.values())
    if not in_plan or sum(p.values() for p in packs.values()) > MAX_PLAN_VALUES:
        if least:
            return _least_of_texts(chunks, subs, column_encoder, batch_encoder, packs)
        # chunks are short beside their distances, so a few bytes of them are work for all cores
        dealt = chunks.repartition(2 * chunks.sparkSession.sparkContext.defaultParallelism)
        return _past_blocks(_encoded(dealt, subs, column_encoder, batch_encoder), packs)
    if column_encoder is not None:
        return _by_column(chunks, subs, column_encoder, packs)
    return _by_batch(chunks, subs, batch_encoder, packs)


def intent_distances(chunks: DataFrame, text: str, pack: Pack, how: str = "all", **encoder) -> DataFrame:
    """One column per intent, an array (``all``) or a number (``min``)."""
    scored = chunk_distances(chunks, text, {"d": pack}, least=how != "all", **encoder)
    columns = [
        (F.col(f"d_{i}") if how == "all" else F.array_min(f"d_{i}")).alias(i) for i in pack.sizes()
    ]
    return scored.select(*chunks.columns, *columns)


def opposed_distances(chunks: DataFrame, text: str, pack: OpposedPack, how: str = "all", **encoder) -> DataFrame:
    """One column per intent, scores of opposed pairs."""
    scored = chunk_distances(
        chunks, text, {"p": pack.positive, "n": pack.negative}, least=how != "all", **encoder
    )
    columns = []
    for i in pack.sizes():
        pos, neg = F.col(f"p_{i}"), F.col(f"n_{i}")
        if how == "all":
            score = F.zip_with(pos, neg, opposed_score)
        else:
            score = opposed_score(F.array_min(pos), F.array_min(neg))
        columns.append(score.alias(i))
    return scored.select(*chunks.columns, *columns)


def encode_texts(df: DataFrame, text: str, batch_encoder, out: str = "vec") -> DataFrame:
    """A vector per row.  A text that is repeated is encoded once in the whole job; null counts as empty."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = batch_encoder()
        for texts in batches:
            vectors = np.asarray(model(texts.tolist()), dtype="float32") if len(texts) else []
            yield pd.Series(list(vectors), dtype=object)

    said = F.coalesce(F.col(text), F.lit(""))
    distinct = df.select(said.alias("_text")).distinct()
    table = stage(distinct.withColumn(out, encode(F.col("_text"))))
    return join_vectors(df, text, table, out)


def join_vectors(df: DataFrame, text: str, table: DataFrame, out: str = "vec") -> DataFrame:
    """I1 with vectors computed before: ``table`` holds ``_text`` and ``out``, a text at most once."""
    return df.join(table, F.coalesce(F.col(text), F.lit("")) == F.col("_text"), "left").drop("_text")


def encode_hashed(df: DataFrame, text: str, width: int = 384, out: str = "vec", unit: bool = False) -> DataFrame:
    """I1 without a model and without Python: counts of words by hash, at unit length if asked for."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width).transform(df.withColumn("_words", words))
    if unit:
        counted = Normalizer(inputCol="_counts", outputCol="_unit").transform(counted).drop("_counts")
    return counted.withColumn(out, vector_to_array("_unit" if unit else "_counts", "float32")).drop("_words", "_counts", "_unit")


# --- built-in encoders -------------------------------------------------------------

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts(text: Column) -> Column:
    """A column encoder without a model: occurrences of each letter."""
    lowered = F.lower(text)
    return F.array(
        *[
            (F.length(lowered) - F.length(F.replace(lowered, F.lit(c), F.lit("")))).cast("double")
            for c in _LETTERS
        ]
    )


def letter_count_matrix(texts: Sequence[str]) -> np.ndarray:
    """The same encoding for the references, on the driver."""
    return np.array([[t.lower().count(c) for c in _LETTERS] for t in texts], dtype="float64")


def hashed_words(width: int = 384) -> Callable[[], BatchEncoder]:
    """A batch encoder without a model: words hashed into a fixed width."""

    def build() -> BatchEncoder:
        from zlib import crc32

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), width))
            for i, t in enumerate(texts):
                for w in t.lower().split():
                    out[i, crc32(w.encode()) % width] += 1.0
            return out

        return encode

    return build
