"""Buckets that are compared within tasks, cut into blocks where they are large.

A bucket of n rows has ceil(n / size) blocks, and each pair of its blocks is a
group of its own, so no task gets a whole large bucket and no pair of rows is
ever a row of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(members: DataFrame, bucket: list[str], row: str, count: str, size: int) -> DataFrame:
    """``members`` once for each block that their own block meets: columns ``_block``, ``_low`` and ``_high``."""
    blocks = F.ceil(F.col(count) / size).cast("int")
    own = members.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64(row, F.lit(3)), "_blocks").cast("int"))
    meets = own.withColumn("_meets", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_block", "_meets").alias("_low"), F.greatest("_block", "_meets").alias("_high")
    others = [c for c in members.columns if c not in (*bucket, count)]
    return meets.select(*bucket, *others, "_block", low, high)


def whole_groups(batches: Iterator[pa.RecordBatch], group: list[str], rows: int = 4000) -> Iterator[pa.Table]:
    """Sorted batches as tables that end where a group ends, of ``rows`` rows or one group."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        table = pa.Table.from_batches(waiting)
        starts = starts_of(table, group)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1]))
            table = table.slice(int(starts[-1])).combine_chunks()
        waiting, held = table.to_batches(), table.num_rows
    if held:
        yield pa.Table.from_batches(waiting)


def starts_of(table: pa.Table, group: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in group:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


