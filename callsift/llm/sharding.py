"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group, which goes to one shard.  Large groups are
packed one by one; small groups are gathered by hash into tiles first, so the
number of things to pack is bounded whatever the number of rows, and the
bounded list is what the driver packs.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.session import stage

#: Tiles of small groups for each shard.
TILES_PER_SHARD = 256
#: A group is large from this part of a shard on, so there are at most so many for each shard.
LARGE_PART = 1 / 256
#: Hash blocks of a shard in which rows are numbered.
BLOCKS = 1024


class BinTree:
    """Bins in a balanced search tree (a treap) by remaining capacity."""

    @dataclass
    class _Node:
        key: tuple[int, int]
        priority: float
        left: BinTree._Node | None = field(default=None)
        right: BinTree._Node | None = field(default=None)

    def __init__(self) -> None:
        self._root: BinTree._Node | None = None
        self._random = random.Random(0)

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        first, node.left = self._split(node.left, key)
        return first, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a.priority < b.priority:
            a.right = self._join(a.right, b)
            return a
        b.left = self._join(a, b.left)
        return b

    def add(self, remaining: int, number: int) -> None:
        below, above = self._split(self._root, (remaining, number))
        self._root = self._join(self._join(below, self._Node((remaining, number), self._random.random())), above)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity that holds ``size``."""
        below, above = self._split(self._root, (size, -1))
        if above is None:
            self._root = below
            return None
        parent, node = None, above
        while node.left is not None:
            parent, node = node, node.left
        if parent is None:
            above = node.right
        else:
            parent.left = node.right
        self._root = self._join(below, above)
        return node.key

    def take_roomiest(self) -> tuple[int, int]:
        parent, node = None, self._root
        while node.right is not None:
            parent, node = node, node.right
        if parent is None:
            self._root = node.left
        else:
            parent.right = node.left
        return node.key


def pack(sizes: list[int], capacity: int, bins: int | None = None) -> list[int]:
    """Bin of each item: largest first, each into the tightest bin that holds it.

    Without ``bins`` a new bin opens when none holds the item, as few as
    best-fit-decreasing needs; an item above the capacity has a bin to itself.
    With ``bins`` there are so many from the start, and what fits nowhere goes
    where most room is left.
    """
    tree, placed, opened = BinTree(), [0] * len(sizes), 0
    if bins is not None:
        for number in range(bins):
            tree.add(capacity, number)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take_tightest(sizes[item])
        if found is None and bins is not None:
            found = tree.take_roomiest()
        elif found is None:
            found, opened = (capacity, opened), opened + 1
        tree.add(found[0] - sizes[item], found[1])
        placed[item] = found[1]
    return placed


def even_capacity(sizes: list[int], bins: int) -> int:
    """Capacity that ``bins`` equal shards need; items above it have shards of their own and don't count."""
    total, left = sum(sizes), bins
    for size in sorted(sizes, reverse=True):
        if left > 1 and size > -(-total // left):
            total, left = total - size, left - 1
        else:
            break
    return -(-total // left) if left else 0


def shard(
    df: DataFrame,
    key: str,
    group: Column,
    size: Column,
    shards: int | None = None,
    capacity: int | None = None,
    carry: dict[str, Column] | None = None,
    tiles_per_shard: int = TILES_PER_SHARD,
) -> DataFrame:
    """Key, ``size``, ``shard`` and ``slot`` of each row, and the columns of ``carry``.

    Name the number of shards (sizes then come out near equal, unless a group
    is larger than a shard) or the ``capacity`` of a shard (then as few shards
    as best-fit-decreasing needs).  ``slot`` counts the rows of a shard from 0,
    by hash block and then by key, so it does not say anything about order.

    Null groups count as one group.  Rows that are alike get slots in any
    order.  An empty table gives an empty one.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("name either the number of shards or their capacity")
    carry = carry or {}
    rows = stage(
        df.select(
            F.col(key),
            size.cast("long").alias("size"),
            F.sha2(F.coalesce(group.cast("string"), F.lit("")).cast("binary"), 256).alias("_group"),
            *[c.alias(name) for name, c in carry.items()],
        )
    )
    total = rows.agg(F.sum("size").alias("n")).first()["n"] or 0
    each = capacity if capacity is not None else max(1, -(-total // shards))
    number = shards if shards is not None else max(1, -(-total // each))
    tiles = number * tiles_per_shard
    tile = F.concat(F.lit("t"), F.pmod(F.xxhash64("_group"), F.lit(tiles)).cast("string"))
    groups = stage(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")))
    large = F.col("_bytes") >= F.lit(max(1.0, each * LARGE_PART))
    units = groups.groupBy(F.when(large, F.col("_group")).otherwise(tile).alias("unit")).agg(F.sum("_bytes").alias("n"))
    # at most number / LARGE_PART groups and number * tiles_per_shard tiles
    listed = sorted((r["unit"], r["n"]) for r in units.collect())
    sizes = [n for _, n in listed]
    if shards is not None:
        placed = pack(sizes, even_capacity(sizes, shards), shards)
    else:
        placed = pack(sizes, each)
    spark = df.sparkSession
    where = spark.createDataFrame([(u, p) for (u, _), p in zip(listed, placed, strict=True)], "unit string, shard int")
    alone = where.filter(~F.col("unit").startswith("t")).withColumnRenamed("shard", "_alone")
    # both are bounded as the list above
    placed_rows = (
        rows.withColumn("_tile", tile)
        .join(F.broadcast(alone), F.col("_group") == F.col("unit"), "left")
        .drop("unit")
        .join(F.broadcast(where.filter(F.col("unit").startswith("t"))), F.col("_tile") == F.col("unit"), "left")
        .withColumn("shard", F.coalesce("_alone", "shard"))
        .withColumn("_block", F.pmod(F.xxhash64(key, "_group"), F.lit(BLOCKS)))
        .select(key, "size", *carry, "shard", "_block", "_group")
    )
    counts = placed_rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("shard").alias("_of"),
        F.col("_block").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy("shard", "_block").orderBy(key, "_group", "size")
    return (
        placed_rows.withColumn("_place", F.row_number().over(within) - 1)
        .join(offsets, (F.col("shard") == F.col("_of")) & (F.col("_block") == F.col("_at")))
        .withColumn("slot", F.col("_offset") + F.col("_place"))
        .select(key, "size", *carry, "shard", "slot")
    )
