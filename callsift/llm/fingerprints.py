"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is a table of cells; each digest goes into one cell of each of three
parts.  A cell holds how many digests it has, their XOR and the XOR of their
check values.  The sketches of two versions subtract cell by cell, so what both
have is gone; cells that hold a single digest give it away, and taking it out
of its other cells lays open more of them.  If that peeling gets stuck, the
pair is tried again with larger sketches.

Everything is DataFrame functions: building sketches and peeling them are a
chain of aggregations that all keep the partitioning by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.session import stage

#: Cells in each part of the sketch that serves as fingerprint.
PART = 8
PARTS = 3
#: Words of a line that count as one paragraph; longer lines are cut.
PARAGRAPH_WORDS = 16
#: Passes over the parts while peeling.
CYCLES = 4


def paragraphs(text: Column, words: int = PARAGRAPH_WORDS) -> Column:
    """Distinct digests of the paragraphs: lines, cut after every ``words`` words.  White space around them counts for nothing."""
    pattern = rf"\S++(?:[^\S\n]++\S++){{0,{words - 1}}}+"
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(97)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(digest: Column, part: int, size, salt) -> Column:
    """Cell of a digest in one part of ``size`` cells."""
    return (F.pmod(F.xxhash64(digest, F.lit(part), salt), size) + part * size).cast("int")


def sketches(rows: DataFrame, by: list[str], digests: str, size=PART, salt: int = 0, sign: str | None = None) -> DataFrame:
    """Rows of cells (by, size, cell, n, key, check) of the sketch of each array of digests.

    ``size`` is a number or a column.  ``sign`` names a column by which the
    contributions of a row count, 1 or -1: sketches of opposite signs that
    share ``by`` come out subtracted.
    """
    width = F.col(size) if isinstance(size, str) else F.lit(size)
    each = F.col(sign).cast("long") if sign else F.lit(1).cast("long")
    said = rows.select(*by, width.alias("size"), each.alias("n"), F.explode(digests).alias("key"))
    cells = F.array(*[_cell(F.col("key"), p, F.col("size"), F.lit(salt)) for p in range(PARTS)])
    said = said.select(*by, "size", "n", "key", _check(F.col("key")).alias("check"), F.explode(cells).alias("cell"))
    return _added(said, by)


def _added(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells that share a place, added up.  Empty ones go."""
    summed = cells.groupBy(*by, "size", "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return summed.filter((F.col("n") != 0) | (F.col("key") != 0) | (F.col("check") != 0))


def as_text(cells: Column) -> Column:
    """A sketch as a string: its cells (cell, n, key, check) in order, in hexadecimal."""
    return F.array_join(
        F.transform(F.array_sort(cells), lambda c: F.concat_ws(".", F.hex(c["cell"]), F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"]))), "-"
    )


#: Cells in which peeling notes what it has found, below the others: on the left only, on the right only.
FOUND_LEFT, FOUND_RIGHT = -1, -2


def peel(cells: DataFrame, by: list[str], salt: int, cycles: int = CYCLES, digests: bool = False) -> DataFrame:
    """Take single digests out of the cells, part after part, and leave what can't be taken.

    In one part a digest has one cell, so it is found once.  What is found is
    added up in the cells ``FOUND_LEFT`` and ``FOUND_RIGHT``: ``n`` is their
    number, negative on the right.  With ``digests`` each has a row of its
    own instead, whose ``size`` is 0.
    """
    for step in range(cycles * PARTS):
        part = step % PARTS
        n, key = F.col("n"), F.col("key")
        pure = (
            (F.col("cell") >= part * F.col("size"))
            & (F.col("cell") < (part + 1) * F.col("size"))
            & ((n == 1) | (n == -1))
            & (F.col("check") == _check(key))
            & (_cell(key, part, F.col("size"), F.lit(salt)) == F.col("cell"))
        )

        def row(cell: Column, n: Column, key: Column, check: Column, size: Column) -> Column:
            return F.struct(size.alias("size"), cell.cast("int").alias("cell"), n.alias("n"), key.alias("key"), check.alias("check"))

        side = F.when(n > 0, F.lit(FOUND_LEFT)).otherwise(F.lit(FOUND_RIGHT))
        if digests:
            taken = row(F.pmod(F.xxhash64(key), F.lit(1 << 30)), n, key, F.col("check"), F.lit(0))
        else:
            taken = row(side, n, F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("size"))
        others = [
            row(_cell(key, p, F.col("size"), F.lit(salt)), -n, key, F.col("check"), F.col("size")) for p in range(PARTS) if p != part
        ]
        same = row(F.col("cell"), n, key, F.col("check"), F.col("size"))
        rows = cells.select(*by, F.explode(F.when(pure, F.array(taken, *others)).otherwise(F.array(same))).alias("x"))
        cells = _added(rows.select(*by, "x.size", "x.cell", "x.n", "x.key", "x.check"), by)
    return cells


def _outcome(peeled: DataFrame, by: list[str]) -> DataFrame:
    """For each pair with a difference: digests only on the left, only on the right, and whether nothing is left over."""
    found = lambda c: F.coalesce(F.sum(F.when(F.col("cell") == c, F.abs("n"))), F.lit(0))
    return peeled.groupBy(*by).agg(
        found(FOUND_LEFT).alias("only_left"), found(FOUND_RIGHT).alias("only_right"), (F.min(F.col("cell") < 0)).alias("solved")
    )


def _larger(pairs: DataFrame, salt: int) -> DataFrame:
    """Sketch size for a retry: a power of two in which all digests of both sides would have room."""
    most = F.size("left") + F.size("right")
    need = F.ceil(most * (0.6 * 2 ** (salt - 1)))
    return pairs.withColumn("cells", F.greatest(F.lit(2 * PART), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(need, F.lit(1))))).cast("int")))


def signed(pairs: DataFrame, by: list[str], *more: str) -> DataFrame:
    """The digests of a pair as two rows: ``sign`` 1 for those on the left, -1 for those on the right."""
    sides = F.array(*[F.struct(F.lit(n).alias("sign"), F.col(side).alias("digests")) for side, n in (("left", 1), ("right", -1))])
    return pairs.select(*by, *more, F.explode(sides).alias("x")).select(*by, *more, "x.sign", "x.digests")


def differences(pairs: DataFrame, by: list[str], partition_by: str) -> DataFrame:
    """(by, only_left, only_right) of pairs whose digests (``left``, ``right``) differ; the others have no row.

    First with sketches as large as the fingerprints, then with larger ones for
    the pairs that got stuck, until none is left.
    """
    cells = sketches(signed(pairs.repartition(partition_by), by), by, "digests", sign="sign")
    tried = stage(_outcome(peel(cells, by, 0, 2), by))
    solved, salt = [tried.filter("solved")], 0
    stuck = tried.filter("not solved").select(*by)
    while not stuck.isEmpty():
        salt += 1
        again = _larger(pairs.join(stuck, by), salt).repartition(partition_by)
        cells = sketches(signed(again, by, "cells"), by, "digests", "cells", salt, "sign")
        tried = stage(_outcome(peel(cells, by, salt), by))
        solved.append(tried.filter("solved"))
        stuck = tried.filter("not solved").select(*by)
    out = solved[0]
    for more in solved[1:]:
        out = out.unionByName(more)
    return out.drop("solved")


def fingerprints_of(rows: DataFrame, by: str, digests: dict[str, str]) -> DataFrame:
    """``by`` and the fingerprint of each array of digests, by the name of its column."""
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("digests")) for i, c in enumerate(digests.values())])
    versions = rows.select(by, F.explode(kinds).alias("x")).select(by, "x.kind", "x.digests").repartition(by)
    cells = sketches(versions, [by, "kind"], "digests")
    held = F.struct("cell", "n", "key", "check")
    lists = [F.collect_list(F.when(F.col("kind") == i, held)).alias(name) for i, name in enumerate(digests)]
    made = cells.groupBy(by).agg(*lists)
    return made.select(by, *[as_text(F.col(name)).alias(name) for name in digests])


#: Stands for a null id, before all others.
NO_ID = -(1 << 63)


def _neighbours(ids: DataFrame) -> DataFrame:
    """(id, prev_id, prev_need): the id before each in ascending order, the last before the first, and a quarter of its length.

    The order is a range-partitioned sort; each partition's rows are numbered
    in it, and the sizes of partitions, one row for each task, make that a
    position in the whole.
    """
    sorted_ids = ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("_n", F.monotonically_increasing_id())
    placed = stage(sorted_ids).withColumn("_part", F.shiftright("_n", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_n") - F.shiftleft("_part", 33)
    # a row for each task of the sort
    placed = stage(placed.join(F.broadcast(offsets), "_part").select("id", "need", position.alias("at")))
    total = placed.count()
    follower = placed.select(F.col("id").alias("prev_id"), F.col("need").alias("prev_need"), F.pmod(F.col("at") + 1, F.lit(max(1, total))).alias("at"))
    return placed.select("id", "at").join(follower, "at").select("id", "prev_id", "prev_need")


def fingerprint(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last quarter of code points (rounded down)
    replaced by as many from the start of the next document, or all it has.
    Likeness is the share of common paragraphs among all of two versions, as
    recovered from the difference of their sketches, and 1 if neither has any.

    A null text is empty.  ``key`` is an integer; rows without one come before
    all others.  If several rows share a key, the next document is the one of
    them with the least digest.  An only document is its own next one.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), whole.alias("whole"))
    length = F.char_length("whole")
    ids = base.groupBy("id").agg(F.max(F.floor(length / 4).cast("int")).alias("need"))
    near = _neighbours(ids)
    here = base.join(stage(near), "id")
    order = Window.partitionBy("id").orderBy("_digest")
    heads = here.select(
        "id", "prev_id", F.xxhash64("whole").alias("_digest"), F.expr("substring(whole, 1, prev_need)").alias("head"), paragraphs(F.col("whole")).alias("next")
    )
    heads = heads.withColumn("_first", F.row_number().over(order)).filter("_first = 1")
    heads = heads.select(F.col("prev_id").alias("id"), "head", "next")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring("whole", F.lit(1), length - quarter), F.substring("head", F.lit(1), quarter))
    rows = (
        base.join(heads, "id")
        .select("id", length.cast("long").alias("n_chars"), F.col("whole"), edited.alias("edited"), "next")
        .select("id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), paragraphs(F.col("whole")).alias("own"), paragraphs(F.col("edited")).alias("changed"), "next")
        .withColumn("row", F.monotonically_increasing_id())  # lasting, as the rows are staged
    )
    rows = stage(rows)
    versions = F.array(F.struct(F.lit(0).alias("which"), F.col("changed").alias("right")), F.struct(F.lit(1).alias("which"), F.col("next").alias("right")))
    pairs = rows.select("row", F.col("own").alias("left"), F.explode(versions).alias("v")).select("row", "left", "v.which", "v.right")
    found = differences(pairs, ["row", "which"], "row")
    one = lambda n, c: F.max(F.when(F.col("which") == n, F.col(c)))
    wide = found.groupBy("row").agg(*[one(n, c).alias(f"{c}_{n}") for n in (0, 1) for c in ("only_left", "only_right")])

    def likeness(n: int) -> Column:
        left, right = (F.coalesce(F.col(f"only_{s}_{n}"), F.lit(0)) for s in ("left", "right"))
        union = F.size("own") + right
        return F.when(union == 0, F.lit(1.0)).otherwise((F.size("own") - left) / union)

    printed = fingerprints_of(rows, "row", {"fingerprint": "own", "edited_fingerprint": "changed"})
    return rows.join(wide, "row", "left").join(printed, "row", "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(key),
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness(0).alias("near_edited"),
        likeness(1).alias("near_next"),
    )
