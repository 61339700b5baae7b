"""Regular-expression columns.

Patterns are written in the Python dialect.  ``(?dU)`` makes Java agree with it
on white space, word characters and line ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as fv

_FLAGS = "(?dU)"
_NO_STRINGS = "array<string>"


def java(pattern: str) -> str:
    """The pattern as Spark has to see it."""
    return _FLAGS + pattern


def fuse(patterns: Sequence[str]) -> str:
    """One alternation that matches whenever any of the patterns does."""
    return java("|".join(f"(?:{p})" for p in patterns))


# Words without one of which no pattern of the family can match: a cheap test before the heavy one.
GATES = {
    "movers": ["moving", "move", "realestat", "house", "reltor"],
    "cancel": ["end", "stop", "terminat", "cancel", "shut", "finish", "break"],
    "holiday": ["holiday", "off", "mov", "rest"],
    "expression": ["mov"],
    "things": ["mov"],
    "negation": ["mov"],
    "past": ["mov"],
}
_GATE_OF = {p: GATES[f] for f, patterns in fv.PATTERNS.items() for p in patterns}


def _gate(patterns: Sequence[str]) -> str:
    words = dict.fromkeys(w for p in patterns for w in _GATE_OF[p])
    firsts = "".join(dict.fromkeys(w[0] for w in words))
    # most positions fail on their first letter
    return f"(?=[{firsts}])(?:{'|'.join(words)})"


def any_match(text: Column, patterns: Sequence[str], gate: bool = True) -> Column:
    """True if any pattern occurs in the text; null text matches nothing.

    If all patterns need certain words, they are tried on texts with such a
    word only.  ``gate=False`` mentions the text once, which is better where it
    is a costly expression.
    """
    if not patterns:
        return F.lit(False)
    test = text.rlike(fuse(patterns))
    if gate and all(p in _GATE_OF for p in patterns):
        test = text.rlike(_gate(patterns)) & test
    return F.coalesce(test, F.lit(False))


def all_matches(text: Column, patterns: Sequence[str], group: int = 0) -> Column:
    """Every match of every pattern, in pattern order."""
    found = [F.regexp_extract_all(text, F.lit(java(p)), F.lit(group)) for p in patterns]
    if not found:
        return F.array().cast(_NO_STRINGS)
    return F.coalesce(F.concat(*found), F.array().cast(_NO_STRINGS))


def matching_indexes(text: Column, patterns: Sequence[str]) -> Column:
    """Numbers of the patterns that occur at least once."""
    return F.array_compact(
        F.array(*[F.when(text.rlike(java(p)), F.lit(i)) for i, p in enumerate(patterns)])
    )


# characters of no meaning that mark the beginning and end of a match
_BEGIN, _END = "\ue000", "\ue001"


def _pieces(text: Column, pattern: str) -> Column:
    """Per match: the match and the length of the gap that precedes it.

    One scan marks the matches, and the marked text is cut at the marks.  Texts
    that hold such a mark themselves are scanned for matches and for gaps.
    """
    parts = F.split(F.regexp_replace(text, java(f"(?:{pattern})"), f"{_BEGIN}$0{_END}"), _BEGIN, -1)

    def cut(found: Column) -> Column:
        # what precedes a match is the rest of the piece before it
        return F.transform(
            F.slice(found, F.lit(2), F.size(found) - 1),
            lambda p, i: F.struct(
                F.substring_index(p, _END, 1).alias("match"),
                F.length(F.substring_index(F.get(found, i), _END, -1)).alias("gap"),
            ),
        )

    def twice() -> Column:
        matches = F.regexp_extract_all(text, F.lit(java(pattern)), F.lit(0))
        gaps = F.split(text, java(pattern), -1)
        return F.zip_with(
            matches,
            F.slice(gaps, F.lit(1), F.size(matches)),
            lambda m, g: F.struct(m.alias("match"), F.length(g).alias("gap")),
        )

    once = F.get(F.transform(F.array(parts), cut), F.lit(0))
    found = F.when(text.contains(_BEGIN) | text.contains(_END), twice()).otherwise(once)
    if pattern in _GATE_OF:
        none = F.array().cast("array<struct<match:string,gap:int>>")
        found = F.when(text.rlike(_gate([pattern])), found).when(text.isNotNull(), none)
    return found


def match_spans(text: Column, pattern: str) -> Column:
    """T4 for one pattern: ``array<struct<start, match>>``, starts from 0."""
    empty = F.array().cast("array<struct<start:int,match:string>>")
    walked = F.aggregate(
        _pieces(text, pattern),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + F.length(p["match"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct((acc["at"] + p["gap"]).alias("start"), p["match"].alias("match")),
            ).alias("out"),
        ),
    )
    return F.coalesce(walked["out"], empty)


def all_spans(text: Column, patterns: Sequence[str]) -> Column:
    """T4: spans of every pattern, in pattern order."""
    return F.concat(*[match_spans(text, p) for p in patterns])


def start_totals(text: Column, patterns: Sequence[str]) -> Column:
    """Number of matches and sum of their starts, as ``struct<n, total>``."""

    def one(pattern: str) -> Column:
        return F.aggregate(
            _pieces(text, pattern),
            F.struct(
                F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("total")
            ),
            lambda acc, p: F.struct(
                (acc["at"] + p["gap"] + F.length(p["match"])).alias("at"),
                (acc["n"] + 1).alias("n"),
                (acc["total"] + acc["at"] + p["gap"]).alias("total"),
            ),
        )

    parts = [one(p) for p in patterns]
    n, total = F.lit(0), F.lit(0).cast("long")
    for part in parts:
        n = n + F.coalesce(part["n"], F.lit(0))
        total = total + F.coalesce(part["total"], F.lit(0).cast("long"))
    return F.struct(n.alias("n"), total.alias("total"))


def keyword_pattern(keyword: str) -> str:
    """The keyword between the boundaries that count as a whole word."""
    return f"({fv.KEYWORD_PREFIX}{keyword}{fv.KEYWORD_SUFFIX})"


def keyword_matches(text: Column, keywords: Sequence[str]) -> Column:
    """T5: distinct stripped keyword matches, sorted."""
    found = all_matches(text, [keyword_pattern(k) for k in keywords])
    return F.array_sort(F.array_distinct(F.transform(found, strip)))


def keyword_spans(text: Column, keywords: Sequence[str]) -> Column:
    """Every keyword occurrence with its start, neither stripped nor unique."""
    return all_spans(text, [keyword_pattern(k) for k in keywords])


def geo_pattern(name: str) -> str:
    """A place or people name between boundaries; the name is group 1."""
    return f"(?:{fv.GEO_PREFIX}({name}){fv.GEO_SUFFIX})"


def strip(text: Column) -> Column:
    """Drop all white space at both ends (``trim`` drops blanks only)."""
    return F.regexp_replace(text, java(r"\A\s+|\s+\z"), "")
