"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

Documents with the same set of shingles are one class; only classes are
compared.  A pair of classes that share a band is a candidate.  Candidates are
examined batch by batch of their signatures and dropped as soon as the
posterior probability that they are similar enough falls below a chosen miss
probability; those left are confirmed on their full sets.

Who is compared with whom: first every member of a bucket with the bucket's
least member, and components are formed of the links.  Then, in each bucket,
members of different components with each other, inside tasks that return
links only.  So every candidate pair is either examined or already connected,
and no table holds all pairs of a large group.
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
from callsift.llm.words import WHITE_SPACE, chunks, mix, word_hashes
from callsift.session import stage, unstage


@dataclass(frozen=True)
class Settings:
    """Similarity is ``share`` / 100.  A signature has ``bands * rows`` values.

    ``step``: signature values that one look compares; ``miss``: posterior
    probability of similarity below which a candidate is dropped; ``block``:
    rows of a bucket that one group compares with as many; ``spokes``: pairs
    of one least member that share a copy of its full set.
    """

    words: int = 5
    share: int = 75
    bands: int = 40
    rows: int = 5
    step: int = 25
    miss: float = 1e-6
    block: int = 4096
    spokes: int = 256
    seed: int = 11


def shingles(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of each text in ascending order, text by text, and their number.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    hashes, counts = word_hashes(texts, WHITE_SPACE)
    per = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    first = np.cumsum(counts) - counts
    start = np.repeat(first - (np.cumsum(per) - per), per) + np.arange(per.sum())
    owner = np.repeat(np.arange(len(counts)), per)
    length = np.minimum(counts, words)[owner]
    rolled = np.zeros(len(start), np.uint64)
    for i in range(words):
        there = i < length
        rolled[there] = mix(rolled[there] * np.uint64(0x9E3779B97F4A7C15) + hashes[start[there] + i] + np.uint64(i + 1))
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    return rolled[new], np.bincount(owner[new], minlength=len(counts))


def _per_text(ufunc, values: np.ndarray, counts: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over the values of each text; ``empty`` for a text without any."""
    out = np.full(len(counts), empty, values.dtype)
    some = counts > 0
    if some.any():
        out[some] = ufunc.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def signatures(hashes: np.ndarray, counts: np.ndarray, settings: Settings) -> np.ndarray:
    """texts x (bands * rows) minima of as many hash functions, as 32-bit numbers."""
    n = settings.bands * settings.rows
    draw = np.random.default_rng(settings.seed).integers(0, 1 << 63, (n, 2), np.uint64)
    out = np.empty((len(counts), n), np.uint32)
    for i, (a, b) in enumerate(draw):
        values = ((hashes * (a | np.uint64(1)) + b) >> np.uint64(32)).astype(np.uint32)
        out[:, i] = _per_text(np.minimum, values, counts, np.uint32(0xFFFFFFFF))
    return out


def _binary(array: np.ndarray) -> pa.Array:
    width = array.dtype.itemsize * array.shape[1]
    return pa.array([row.tobytes() for row in array] if width else [b""] * len(array), pa.binary())


def sketch(df: DataFrame, key: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """key, n_shingles, set_a, set_b (digest of the set), signature, band of each row.

    ``band`` holds a 64-bit hash of each band.  ``signature`` holds the lowest
    byte of each value: equal values have equal bytes, so no match is lost,
    and one in 256 of the others passes for a match until the full sets are
    compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            hashes, counts = shingles(part.column("_text"), settings.words)
            signed = signatures(hashes, counts, settings)
            a = _per_text(np.add, mix(hashes), counts, np.uint64(0))
            b = _per_text(np.bitwise_xor, mix(hashes ^ np.uint64(0x5555555555555555)), counts, np.uint64(0))
            band = np.zeros((len(counts), settings.bands), np.uint64)
            for row in range(settings.rows):
                band = mix(band * np.uint64(0x9E3779B97F4A7C15) + signed[:, row :: settings.rows].astype(np.uint64))
            columns = [
                part.column("_key"),
                pa.array(counts.astype(np.int64)),
                pa.array(a.view(np.int64)),
                pa.array(b.view(np.int64)),
                _binary(signed.astype(np.uint8)),
                _binary(band),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "n_shingles", "set_a", "set_b", "signature", "band"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {kind}, n_shingles long, set_a long, set_b long, signature binary, band binary"
    return rows.mapInArrow(run, schema)


def least_matches(settings: Settings) -> list[int]:
    """Matches that a candidate needs after each look to go on.

    The prior is uniform; after m matches of n, similarity has the density of
    Beta(m + 1, n - m + 1), and P(similarity >= t) is a binomial sum.
    """
    t, needed = settings.share / 100, []
    for n in range(settings.step, settings.bands * settings.rows + 1, settings.step):
        tail, m = (1 - t) ** (n + 1), 0
        while tail < settings.miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        needed.append(m)
    return needed


def examine(pairs: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that no look at their signatures (``signed``: node, signature) has dropped."""
    needed = least_matches(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_matrix(batch.column(c), np.uint8) for c in ("_left", "_right"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for look, least in enumerate(needed):
                span = slice(look * settings.step, (look + 1) * settings.step)
                matches = matches + (left[alive, span] == right[alive, span]).sum(axis=1)
                keep = matches >= least
                alive, matches = alive[keep], matches[keep]
                if not len(alive):
                    break
            yield batch.select(["a", "b"]).take(pa.array(alive))

    with_left = pairs.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("_left")), "a")
    both = with_left.join(signed.select(F.col("node").alias("b"), F.col("signature").alias("_right")), "b")
    return both.select("a", "b", "_left", "_right").mapInArrow(run, pairs.select("a", "b").schema)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def full_sets(documents: DataFrame, settings: Settings) -> DataFrame:
    """(node, _set): the ascending shingle hashes of each document as bytes.  ``documents``: node and ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            hashes, counts = shingles(part.column("_text"), settings.words)
            ends = np.cumsum(counts)
            sets = [hashes[e - c : e].tobytes() for c, e in zip(counts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], names=["node", "_set"])

    kind = documents.schema["node"].dataType.simpleString()
    return documents.select("node", "_text").mapInArrow(run, f"node {kind}, _set binary")


def confirm(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Pairs of one ``a`` meet, some ``spokes`` of them in a group, with its set
    once and the set of each ``b``.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / settings.spokes).cast("int").alias("_salts"))
    firsts = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), F.col("a").alias("node"), F.lit(0).alias("_of"))
    others = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), "_salts").cast("int").alias("_salt"), F.col("b").alias("node"), F.lit(1).alias("_of"))
    group = ["a", "_salt"]
    full = firsts.unionByName(others).join(sets, "node")
    ordered = full.select(*group, "_of", "node", "_set").repartition(*group).sortWithinPartitions(*group, "_of", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []
        for batch in batches:
            keep = []
            rows = zip(*(batch.column(c).to_pylist() for c in (*group, "_of")), batch.column("_set"), strict=True)
            for a, salt, of, found in rows:
                found = np.frombuffer(found.as_buffer(), np.uint64)
                if (a, salt) != now:
                    now, own = (a, salt), []
                if of == 0:
                    own.append(found.copy())  # several where a key has several texts
                keep.append(of == 1 and any(_similar(x, found, settings) for x in own))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("node")], names=["a", "b"])

    return ordered.mapInArrow(run, f"a {kind}, b {kind}")


def across_components(members: DataFrame, sketches: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between members of a bucket whose groups (``_group``) differ.

    The members of a bucket meet in a task, block by block.  First with their
    signatures only, to tell which of them have a candidate there; then those
    with their full sets.  What leaves the second task are links, enough of
    them to connect what is linked there.
    """
    bucket = ["_band", "_hash"]
    counts = stage(members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")))
    blocks = in_blocks(members.join(counts, bucket), bucket, "node", "_n", settings.block)
    group = [*bucket, "_low", "_high"]
    signed = blocks.join(sketches, "node").select("node", "_group", "signature", "band", "_block", *group)
    kind = members.schema["node"].dataType.simpleString()
    needed = least_matches(settings)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, places in _groups(batches, group):
            found = np.zeros(table.num_rows, bool)
            for start, part in places:
                for p, q in _candidates(part, needed, settings):
                    found[start + p] = found[start + q] = True
            yield from table.select(["node", "_group", "signature", "band", "_block", *group]).filter(pa.array(found)).combine_chunks().to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, places in _groups(batches, group):
            names = table.column("node").combine_chunks()
            found = [(start + p, start + q) for start, part in places for p, q in _links_in_group(part, needed, settings)]
            if found:
                a, b = (names.take(pa.array(x)) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(*group).sortWithinPartitions(*group, "node")

    left = stage(dealt(signed).mapInArrow(candidates, signed.schema))
    return dealt(left.join(sets, "node")).mapInArrow(linked, f"a {kind}, b {kind}").distinct()


def _groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.Table, list[tuple[int, pa.Table]]]]:
    """Tables of whole groups, with the place of each group in it and its rows."""
    for table in whole_groups(batches, group, 500):
        starts = np.append(starts_of(table, group), table.num_rows).tolist()
        yield table, [(a, table.slice(a, b - a)) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _candidates(table: pa.Table, needed: list[int], settings: Settings, most: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows of different groups whose signatures pass all looks; a pair that shares an earlier band is left to that one."""
    _, group = np.unique(np.asarray(table.column("_group").to_pylist(), object), return_inverse=True)
    if group.max() == 0:
        return
    signed = _matrix(table.column("signature").combine_chunks(), np.uint8)
    bands = _matrix(table.column("band").combine_chunks(), np.uint64)
    band, low, high = (table.column(c)[0].as_py() for c in ("_band", "_low", "_high"))
    block = table.column("_block").to_numpy()
    left = np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    rows = max(1, most // max(1, len(right)))
    for at in range(0, len(left), rows):
        some = left[at : at + rows]
        apart = group[some][:, None] != group[right][None, :]
        if low == high:
            apart &= some[:, None] < right[None, :]
        i, j = np.nonzero(apart)
        p, q = some[i], right[j]
        matches = np.zeros(len(p), np.int64)
        for look, least in enumerate(needed):
            span = slice(look * settings.step, (look + 1) * settings.step)
            matches = matches + (signed[p, span] == signed[q, span]).sum(axis=1)
            keep = matches >= least
            p, q, matches = p[keep], q[keep], matches[keep]
        mine = (bands[p] == bands[q]).argmax(axis=1) == band
        yield p[mine], q[mine]


def _links_in_group(table: pa.Table, needed: list[int], settings: Settings) -> list[tuple[int, int]]:
    """Places of rows that are linked, across groups only."""
    _, group = np.unique(np.asarray(table.column("_group").to_pylist(), object), return_inverse=True)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("_set")]
    found = []
    for p, q in _candidates(table, needed, settings):
        for x, y in zip(p.tolist(), q.tolist(), strict=True):
            if group[x] != group[y] and _similar(sets[x], sets[y], settings):
                found.append((x, y))
                group[group == group[y]] = group[x]
    return found


def _similar(p: np.ndarray, q: np.ndarray, settings: Settings) -> bool:
    if 100 * min(len(p), len(q)) < settings.share * max(len(p), len(q)):
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= settings.share * (len(p) + len(q) - both)


def links(sketches: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that connect what is to be connected; see above.

    ``sketches``: node, signature, band of each class; ``documents``: node and
    ``_text`` of at least these.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.lit(settings.bands - 1)), lambda i: F.substring("band", i * 8 + 1, F.lit(8)))
    bands = sketches.select("node", F.posexplode(hashes).alias("_band", "_bytes")).select("node", "_band", F.xxhash64("_bytes").alias("_hash"))
    shared = stage(
        bands.groupBy("_band", "_hash").agg(F.min("node").alias("_lead"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    )
    members = stage(bands.join(shared, ["_band", "_hash"]))
    unstage(shared)
    sets = stage(full_sets(documents.join(members.select("node").distinct(), "node", "left_semi"), settings))
    with_lead = stage(members.filter("node != _lead").select(F.col("_lead").alias("a"), F.col("node").alias("b")).distinct())
    left = stage(examine(with_lead, sketches.select("node", "signature"), settings))
    first = stage(confirm(left, sets, settings))
    groups = stage(connected(first, "a", "b"))
    for used in (with_lead, left):
        unstage(used)
    placed = members.join(groups, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    placed = stage(placed.select("_band", "_hash", "node", "_group"))
    for used in (members, groups):
        unstage(used)
    ends = placed.groupBy("_band", "_hash").agg(F.min("_group").alias("_x"), F.max("_group").alias("_y"))
    rest = stage(placed.join(ends.filter("_x < _y").select("_band", "_hash"), ["_band", "_hash"], "left_semi"))
    unstage(placed)
    found = stage(first.unionByName(across_components(rest, sketches, sets, settings)))
    for used in (first, rest, sets):
        unstage(used)
    return found


#: Parts that the rows of a class of equal sets are dealt over.
SALTS = 16


def near_duplicates(df: DataFrame, key: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """key, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    ``component_id`` is the least key that links lead to, the own one
    included, and ``kept`` says that it is the own key.  A null text or one
    without words is linked with nothing.  Rows that share a key count as one
    node with all their links.  A row without a key has no component and is
    kept.  Keys of any type that can be ordered will do.
    """
    sketched = stage(sketch(df, key, text, settings))
    same = ["set_a", "set_b", "n_shingles"]
    listed = stage(sketched.select("_key", *same))
    some = (F.col("n_shingles") > 0) & F.col("_key").isNotNull()
    copies = listed.filter(some).groupBy(*same).agg(F.min("_key").alias("_least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    # a class may hold a third of all rows, so they are dealt over parts, each with the least key
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = listed.filter(some).withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    found = salted.join(copies, [*same, "_salt"]).filter("_key != _least").select("_least", "_key", *same)
    found = stage(found.distinct())
    classes = sketched.filter(some).join(found.drop("_least"), ["_key", *same], "left_anti").dropDuplicates(["_key", *same])
    sketches = stage(classes.select(F.col("_key").alias("node"), "signature", "band"))
    unstage(sketched)
    documents = df.select(F.col(key).alias("node"), F.col(text).alias("_text"))
    near = links(sketches, documents, settings)
    unstage(sketches)
    copy_links = found.select(F.col("_least").alias("a"), F.col("_key").alias("b"))
    groups = stage(connected(copy_links.unionByName(near), "a", "b"))
    for used in (found, near):
        unstage(used)
    placed = listed.select("_key", "n_shingles").join(groups, F.col("_key") == F.col("node"), "left")
    component = F.coalesce("component", "_key")
    return placed.select(
        F.col("_key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept"),
    )
