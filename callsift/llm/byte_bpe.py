"""Byte-level BPE: texts to token ids with spans, and back.

The ranks of a byte vocabulary become a model of the ``tokenizers`` library.
Bytes stand as the printable characters of the usual byte table, so every text
has an encoding and decoding gives back its exact bytes.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longer texts are encoded in pieces of about this many characters.
PIECE = 50_000


def byte_characters() -> list[str]:
    """The character for each byte: itself where printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    moved = {b: chr(0x100 + n) for n, b in enumerate(others)}
    return [moved.get(b, chr(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ids of a rank file: base64, space, id in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """A vocabulary, ready to encode and decode; one in a process.

    The pattern cuts texts into matches.  Most matches recur, so each is
    encoded once and remembered, up to ``REMEMBERED`` of them.
    """

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import models

        ranks, self.table = read_ranks(path), dict(enumerate(byte_characters()))
        spelled = {token: "".join(map(self.table.__getitem__, token)) for token in ranks}
        # by rank, every pair of tokens that makes up the token: any of them may meet in a text
        merges = [
            (spelled[token[:i]], spelled[token[i:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        vocabulary = {spelled[token]: rank for token, rank in ranks.items()}
        self.model = models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0)
        self.matches = regex.compile(pattern).findall
        unspell = {c: b for b, c in self.table.items()}
        spellings = [b""] * (max(ranks.values()) + 1)
        for token, rank in vocabulary.items():
            spellings[rank] = bytes(map(unspell.__getitem__, token))
        self.lengths = np.fromiter(map(len, spellings), np.int64, len(spellings))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spellings), np.uint8)
        self.known: dict[str, tuple[int, ...]] = {}
        self.covered: dict[str, list[tuple[int, int]]] = {}

    def learn(self, matches) -> None:
        """Encode the matches that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known, self.covered = {}, {}
        new = [m for m in set(matches) if m not in self.known]
        spelled = [m.encode("utf-8").decode("latin-1").translate(self.table) for m in new]
        for match, word in zip(new, spelled, strict=True):
            self.known[match] = tuple([token.id for token in self.model.tokenize(word)])

    def ids(self, text: str) -> np.ndarray:
        parts = []
        for part in pieces(text):
            matches = self.matches(part)
            found = list(map(self.known.get, matches))
            if None in found:
                self.learn(m for m, ids in zip(matches, found, strict=True) if ids is None)
                found = [self.known[m] if ids is None else ids for m, ids in zip(matches, found, strict=True)]
            parts.append(np.fromiter(chain.from_iterable(found), np.int32))
        return np.concatenate(parts)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Characters (start, end) that each token covers: the character of its first byte to that of its last."""
        out, at = [], 0
        for match in chain.from_iterable(map(self.matches, pieces(text))):
            self.learn((match,))
            if match not in self.covered:
                # a byte is of the character whose first byte came last
                of = np.cumsum([b & 0xC0 != 0x80 for b in match.encode("utf-8")]) - 1
                ends = np.cumsum(self.lengths[list(self.known[match])])
                begins = ends - self.lengths[list(self.known[match])]
                self.covered[match] = list(zip(of[begins].tolist(), (of[ends - 1] + 1).tolist(), strict=True))
            out += [(at + a, at + b) for a, b in self.covered[match]]
            at += len(match)
        return out

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, gathered from the table of all spellings."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[at].tobytes()


#: Matches that a process remembers the ids of (some 250 bytes each).
REMEMBERED = 150_000


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def pieces(text: str, size: int = PIECE) -> list[str]:
    """A long text in parts that encode as the whole does.

    No match of the pattern crosses from a character into white space after
    it, and none looks further ahead than that, so these are exact cuts.
    """
    parts, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not (text[at].isspace() and not text[at - 1].isspace()):
            at += 1
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]


def encode_texts(texts: list[str | None], path: str, pattern: str, spans: bool = False):
    """Ids of each text and, if asked for, the characters (start, end) that each token covers.

    A token that ends inside a character has that character in its span, as
    does the token that begins there.
    """
    own = codec(path, pattern)
    for text in texts:
        yield own.ids(text or "").tolist(), own.spans(text or "") if spans else []


def decode_ids(ids, path: str, pattern: str) -> bytes:
    """The bytes of a list of ids.  They may begin or end inside a character."""
    return codec(path, pattern).spell(np.asarray(ids, np.int64))


class TextDecoder:
    """Text of ids that come in parts: bytes of a character cut by a part wait for the rest of it."""

    def __init__(self, path: str, pattern: str):
        import codecs

        self._spell = functools.partial(decode_ids, path=path, pattern=pattern)
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids, last: bool = False) -> str:
        return self._text.decode(self._spell(ids), last)


def _mapped(df: DataFrame, fields: list[T.StructField], function) -> DataFrame:
    """``df`` with more columns; they replace columns of the same name."""
    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few rows at a time: ids take more room than the text they come from
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = function(part)
                columns = [part.column(c) for c in kept] + [a for a, _ in made]
                names = kept + [name for _, name in made]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text: str, path: str, pattern: str, spans: bool = False) -> DataFrame:
    """Add ``ids`` (array of int) and, if asked for, ``starts`` and ``ends`` in characters.

    A null text is empty.  The vocabulary file has to be installed on executors.
    """
    numbers = T.ArrayType(T.IntegerType(), False)
    names = ["ids", "starts", "ends"] if spans else ["ids"]

    def rows(batch):
        found = list(encode_texts(batch.column(text).to_pylist(), path, pattern, spans))
        made = [(pa.array([i for i, _ in found], pa.list_(pa.int32())), "ids")]
        for side, name in enumerate(names[1:]):
            made.append((pa.array([[s[side] for s in c] for _, c in found], pa.list_(pa.int32())), name))
        return made

    return _mapped(df, [T.StructField(n, numbers, False) for n in names], rows)


def decode(df: DataFrame, ids: str, path: str, pattern: str, out: str = "decoded") -> DataFrame:
    """Add the bytes that a column of ids stands for.  Null ids stand for no bytes."""

    def rows(batch):
        found = [decode_ids(i or (), path, pattern) for i in batch.column(ids).to_pylist()]
        return [(pa.array(found, pa.binary()), out)]

    return _mapped(df, [T.StructField(out, T.BinaryType(), False)], rows)


def encode_and_decode(df: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """Add ``ids`` and ``decoded``, the bytes of those ids, in one pass through Python."""

    def rows(batch):
        own = codec(path, pattern)
        found = [own.ids(t or "") for t in batch.column(text).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in found])])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
        return [(ids, "ids"), (pa.array([own.spell(i) for i in found], pa.binary()), "decoded")]

    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("decoded", T.BinaryType(), False),
    ]
    return _mapped(df, fields, rows)


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)
