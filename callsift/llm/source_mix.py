"""Mixing sources to target weights.

Shares follow the weights until a source would be read more than ``most``
times; what it cannot take goes to the others by weight (capped water-filling).
Each source is then read whole as often as it goes, and a seeded part of its
rows once more.  Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.session import stage

#: Digits of the hash that name a block of a source: 4,096 blocks.  Only rows of one block are sorted together.
BLOCK_DIGITS = 3


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, source: str, weights=(1, 2, 3)) -> DataFrame:
    """Weights in turn, sources by code point, null last.  One row per source, so one task sorts them."""
    order = Window.orderBy(F.col(source).isNull(), F.col(source).cast("binary"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))


def water_fill(sources: DataFrame, size: str = "source_size", weight: str = "weight", most: float = 3.0) -> DataFrame:
    """Add ``target``: shares of the whole by weight, none above ``most`` times its size.

    With sources in the order of cap by weight, those before some point are
    clamped and the rest share what is left; the first source that can take
    its share marks that point.  One row per source.
    """
    cap = F.col(size) * F.lit(float(most))
    ratio = F.when(F.col(weight) > 0, cap / F.col(weight)).otherwise(F.lit(float("inf")))
    order = Window.orderBy("_ratio", "_cap", F.xxhash64(*[c for c in sources.columns]))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.col("_weights") - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
    )
    return (
        sources.withColumn("_cap", cap)
        .withColumn("_ratio", ratio)
        .withColumn("_total", F.sum(size).over(everything).cast("double"))
        .withColumn("_weights", F.sum(weight).over(everything))
        .withColumn("_level", F.when(F.col(weight) > 0, level))
        .withColumn("_level", F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")))
        .withColumn("_level", F.first("_level", ignorenulls=True).over(order.rowsBetween(*whole)))
        .withColumn("target", F.least("_cap", F.coalesce(F.col("_level") * F.col(weight), F.col("_cap"))))
        .drop("_cap", "_ratio", "_total", "_weights", "_level")
    )


def mix(
    df: DataFrame,
    key: str,
    source: str,
    size: Column,
    weights=(1, 2, 3),
    most: float = 3.0,
    seed: int = 0,
    carry: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """One row per row of ``df``: key, ``source``, ``size``, ``source_size``, ``target``, ``repeats``, ``taken``, ``carried``.

    ``carried`` is a structure of the columns named in ``carry`` (without any: of the key).

    ``repeats`` says how often the mix holds the row and ``taken`` is
    ``repeats * size``.  The rows of a source stand in a seeded order; after
    the whole readings, those before the point where the target is met are
    taken once more, so a source misses its target by at most half a row.

    A null source is a source like others and comes last.  Rows of size 0 are
    taken like others; sources without any size get target 0 and no row.
    Rows alike in key and size may swap places, which changes nothing.  An
    empty table gives an empty one.
    """
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    rows = stage(
        df.select(
            F.col(key),
            F.col(source).alias("source"),
            size.cast("long").alias("size"),
            place.alias("_place"),
            F.substring(place, 1, BLOCK_DIGITS).alias("_block"),
            F.struct(*(carry or [key])).alias("carried"),
        )
    )
    sums = rows.groupBy("source", "_block").agg(F.sum("size").alias("_sum"))
    sources = sums.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    filled = water_fill(cyclic_weights(sources, "source", weights), most=most)
    filled = filled.select(F.col("source").alias("_of"), "source_size", "target")
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    readings = F.col("target") / F.col("source_size")
    plan = (
        sums.join(filled, F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(readings)).otherwise(F.lit(0)))
        .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size") - F.col("_before"))
        .select(F.col("source").alias("_of"), F.col("_block").alias("_at"), "source_size", "target", "_whole", "_rest")
    )
    within = Window.partitionBy("source", "_block").orderBy("_place", key, "size")
    mine = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the row on the border comes in if more than half of it is still missing
    more = (F.col("_rest") > 0) & (mine - F.col("size") / 2 < F.col("_rest"))
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_at")))
        .withColumn("repeats", (F.col("_whole") + more.cast("int")).cast("long"))
        .withColumn("taken", F.col("repeats") * F.col("size"))
        .select(key, "source", "size", "source_size", "target", "repeats", "taken", "carried")
    )
