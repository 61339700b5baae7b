"""Positions and ranks that survive a key holding a large share of the rows.

A window partitioned by a key sends all rows of the key to one task.  That is
the cheapest plan where keys are small by nature, as conversations are.  Where
they are not, the caller asks for a range-partitioned sort, whose partitions
cut through a key.  No plan is picked by looking at the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.session import stage

_ROW_BITS = 33


def global_positions(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """Dense position of every row in the global order, from 0.

    The sort is range partitioned.  Each row keeps its partition and its place
    in it; the partition sizes, one row per task, give the offsets.  The sorted
    rows are staged first, so both passes see the same partitions.
    """
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = stage(placed)
    part = F.shiftright("_id", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_part = F.col("_id") - F.shiftleft(part, _ROW_BITS)
    return (
        placed.withColumn("_part", part)
        # one row per sort task: bounded by the number of partitions
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + in_part)
        .drop("_id", "_part", "_offset")
    )


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    out: str = "chunk_id",
    large_keys: bool = False,
) -> DataFrame:
    """Position of each row within its key, from 0.

    Rows that are equal in ``order`` follow a hash of the whole row, so
    positions do not depend on the order in which rows arrive.

    ``large_keys`` names the plan.  False: a window for each key, for keys
    whose rows one task can sort.  True: one sort over all rows that is staged,
    whatever a key holds.
    """
    order = [*order, F.xxhash64(*df.columns)]
    if not large_keys:
        window = Window.partitionBy(key).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(window) - 1).cast("long"))
    numbered = global_positions(df, [key, *order], "_position")
    firsts = numbered.groupBy(F.col(key).alias("_key")).agg(F.min("_position").alias("_first"))
    return (
        numbered.join(firsts, F.col(key).eqNullSafe(F.col("_key")))
        .withColumn(out, F.col("_position") - F.col("_first"))
        .drop("_key", "_position", "_first")
    )


def first_rows(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of every key.

    The limit is applied in each input partition before the exchange, so a
    large key sends ``n`` rows per task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def mixed(column: Column) -> Column:
    """Arithmetic hash of an integer id, within [0, 1000003).

    Ids that are no integers, null among them, are hashed to one first.
    """
    number = F.coalesce(column.try_cast("long"), F.xxhash64(column))
    return F.pmod(F.pmod(number, F.lit(MIXED_RANGE)) * F.lit(2654435761), F.lit(MIXED_RANGE))


MIXED_RANGE = 1000003


def hash_ranks(
    df: DataFrame,
    hash_column: Column,
    hash_range: int,
    tie: Sequence[str],
    by: Sequence[str] = (),
    out: str = "hash_rank",
    blocks: int | None = None,
) -> DataFrame:
    """Rank from 1 in the order of a uniform hash, per group ``by`` or overall.

    The hash range is cut into blocks, so a group of any size spreads over
    ``blocks`` tasks (16 for each shuffle partition unless stated otherwise):
    ranks within a block plus the sizes of earlier blocks.  A null hash counts
    as 0, and ``tie`` goes on from there, nulls first.
    """
    by = list(by)
    blocks = blocks or 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn("_hash", F.coalesce(hash_column, F.lit(0))).withColumn(
        "_block", F.floor(F.col("_hash") * F.lit(blocks) / F.lit(hash_range)).cast("int")
    )
    sizes = cut.groupBy(*by, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = [f"_by{i}" for i in range(len(by))]
    offsets = sizes.select(
        *[F.col(b).alias(s) for b, s in zip(by, same, strict=True)],
        F.col("_block").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    match = F.col("_block") == F.col("_of")
    for b, s in zip(by, same, strict=True):
        match = match & F.col(b).eqNullSafe(F.col(s))
    within = Window.partitionBy(*by, "_block").orderBy("_hash", *tie)
    return (
        cut.withColumn("_place", F.row_number().over(within))
        .join(offsets, match)
        .withColumn(out, F.col("_offset") + F.col("_place"))
        .drop("_hash", "_block", "_place", "_offset", "_of", *same)
    )
