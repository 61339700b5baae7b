"""Words of a column of texts as numbers, straight from the Arrow buffers.

Nothing here builds a Python string per word.  A column of UTF-8 texts is one
run of bytes; words are runs between separator bytes, and a word's hash comes
from prefix sums over that run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of an ASCII letter or digit, or of a character beyond ASCII.
NOT_ALPHANUMERIC = np.ones(256, bool)
for _span in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)):
    NOT_ALPHANUMERIC[list(_span)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offset of each text (one more than texts).  Null counts as empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text (ASCII letters lower-cased), and the number of words of each text."""
    data, offsets = buffers(texts)
    inside = ~separators[data]
    # a word also ends where its text ends
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.searchsorted(begin, offsets[1:]) - np.searchsorted(begin, offsets[:-1])
    if not len(begin):
        return np.zeros(0, np.uint64), counts
    length = end - begin
    sums = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        # words that begin within one window; they are hashed by where they stand in it
        upto = max(at + 1, int(np.searchsorted(begin, begin[at] + WINDOW)))
        sums[at:upto] = _sums(data[begin[at] : end[upto - 1]], begin[at:upto] - begin[at], end[at:upto] - begin[at])
        at = upto
    return mix(sums ^ mix(length.astype(np.uint64) + np.uint64(1))), counts


#: Bytes that are hashed together: numpy needs some 50 bytes for each.
WINDOW = 1_000_000


def _sums(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """h(word) = sum of byte_i * base**i with i from 0, by prefix sums modulo 2**64."""
    power = np.empty(len(data) + 1, np.uint64)
    power[0] = 1
    power[1:] = _BASE
    np.multiply.accumulate(power, out=power)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * power[:-1], out=prefix[1:])
    back = power
    back[0] = 1
    back[1:] = _BASE_INVERSE
    np.multiply.accumulate(back, out=back)
    return (prefix[end] - prefix[begin]) * back[begin]


def chunks(batches, text: str, most_bytes: int = 1_000_000):
    """Pieces of Arrow batches with few bytes of text each, at least one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for at, n in enumerate(size):
            if at > start and total + n > most_bytes:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
