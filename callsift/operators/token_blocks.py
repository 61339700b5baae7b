"""Work on tokens a block of rows at a time, with Arrow and numpy inside the tasks.

Within a block of rows most tokens repeat, so a task numbers the words of a
block, and only what is distinct in it leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.session import stage

# 1,024 rows of a task are a block, and tokens are numbered so many at once
BLOCK_BITS = 10
MOST_TOKENS = 2_000_000


def _pieces(batch: pa.RecordBatch, tokens: str) -> Iterator[pa.RecordBatch]:
    """Pieces of about ``MOST_TOKENS`` tokens; a row is never cut."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch[tokens]), 0).to_numpy(zero_copy_only=False))
    start, before = 0, 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, before + MOST_TOKENS, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def _numbered(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each token, the words by number, index of the row of each token); null is a word, too."""
    coded = pc.list_flatten(lists).dictionary_encode(null_encoding="encode")
    return (
        coded.indices.to_numpy(zero_copy_only=False),
        coded.dictionary,
        pc.list_parent_indices(lists).to_numpy(zero_copy_only=False),
    )


def _words_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in _pieces(batch, "_tokens"):
            numbers, words, row = _numbered(piece["_tokens"])
            if not len(numbers):
                continue
            blocks, of = np.unique(piece["_block"].to_numpy(), return_inverse=True)
            found = np.unique(of[row] * len(words) + numbers)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[found // len(words)]), words.take(pa.array(found % len(words)))], ["_block", "_word"]
            )


def distinct_words(df: DataFrame, tokens: str) -> DataFrame:
    """``(_word)``: every word of the tokens once; of a block of rows a task sends each word once."""
    rows = df.select(F.lit(0).cast("long").alias("_block"), F.col(tokens).alias("_tokens"))
    return rows.mapInArrow(_words_of_blocks, "_block long, _word string").select("_word").distinct()


def _rebuilt(values: pa.Array, lengths: np.ndarray, lists: pa.Array) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values.cast(lists.type.value_type), mask=lists.is_null())


def _whole(column: pa.ChunkedArray) -> pa.Array:
    one = column.combine_chunks()
    return one if isinstance(one, pa.Array) else pa.concat_arrays(one.chunks)


def _put(rows: pa.Table, known: pa.Table) -> pa.Table:
    """The tokens of a block, each that is known replaced by its ``_new``, or left out where that is null."""
    lists = _whole(rows["_tokens"])
    flat = pc.list_flatten(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    if known.num_rows:
        place = pc.index_in(flat, value_set=_whole(known["_word"]))
        new = _whole(known["_new"]).take(place)
        keep = pc.or_(pc.is_null(place), pc.is_valid(new))
        row = pc.list_parent_indices(lists).filter(keep).to_numpy(zero_copy_only=False)
        flat = pc.coalesce(new, flat).filter(keep)
        lengths = np.bincount(row, minlength=len(lists))
    return pa.table({"_row": rows["_row"], "_new_tokens": _rebuilt(flat, lengths, lists)})


def with_words_replaced(df: DataFrame, tokens: str, words: DataFrame) -> DataFrame:
    """``df`` with tokens replaced by ``words``: ``(_word, _new)``, one row a word; a null ``_new`` drops the token.

    Each block of rows looks a word up once, and the words found in the table
    come back to the block, so a frequent word costs a row for each block, and
    a task holds one block with its words.  Rows need no key.
    """
    named = F.monotonically_increasing_id()
    rows = stage(df.withColumn("_row", named).withColumn("_block", F.shiftright("_row", BLOCK_BITS)))
    held = rows.select("_row", "_block", F.col(tokens).alias("_tokens"))
    said = held.select("_block", "_tokens").mapInArrow(_words_of_blocks, "_block long, _word string")
    known = said.join(words, "_word").select("_block", "_word", "_new")
    put = held.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(_put, "_row long, _new_tokens array<string>")
    kept = [F.col("_new_tokens").alias(c) if c == tokens else F.col(c) for c in df.columns]
    return rows.join(put, "_row").select(*kept)


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        null = pc.is_null(batch["_of"])
        for part in (batch.filter(null), batch.filter(pc.invert(null))):
            for piece in _pieces(part, "_tokens"):
                piece = piece.take(pc.array_sort_indices(piece["_of"]))
                numbers, words, row = _numbered(piece["_tokens"])
                if not len(numbers):
                    continue
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                pos = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
                keys = piece["_of"].fill_null(0).to_numpy(zero_copy_only=False)[row]
                order = np.lexsort((pos, keys)) if np.any((keys[1:] == keys[:-1]) & (row[1:] != row[:-1])) else np.arange(len(row))
                # of several writes to one place the last one stays: that of the first token
                first = np.empty(len(words), np.int64)
                first[numbers[order[::-1]]] = order[::-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        words,
                        piece["_of"].take(pa.array(row[first])),
                        pa.array(np.bincount(numbers, minlength=len(words)).astype(np.int64)),
                        pa.array(pos[first].astype(np.int32)),
                    ],
                    ["token", "_of", "n", "pos"],
                )


def first_places(df: DataFrame, key: Column, tokens: str) -> DataFrame:
    """``(token, _of, n, pos)``: words of blocks of rows with their counts, least key and first place in it.

    ``key`` is a whole number.  Rows of a null key are counted apart.  A token
    may come from several blocks.
    """
    rows = df.select(key.cast("long").alias("_of"), F.col(tokens).alias("_tokens"))
    return rows.mapInArrow(_firsts, "token string, _of long, n long, pos int")
