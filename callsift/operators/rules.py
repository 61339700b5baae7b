"""Keyword rules over sentences.

Pattern packs are plain dictionaries ``family -> list of patterns``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.regex import any_match
from callsift.operators.calls import ID, spoken_order
from callsift.operators.ordering import first_rows, hash_ranks, number_rows
from callsift.session import stage

Pack = Mapping[str, Sequence[str]]
_TEXT = "sntnce"
_ROLE = "sntnce_partcpnt_role"


def is_customer(role: Column) -> Column:
    """F8"""
    return role == fv.CUSTOMER_ROLE


def none_of(text: Column, pack: Pack, families: Sequence[str]) -> Column:
    """True when no pattern of the families occurs: one scan of the text."""
    return ~any_match(text, [p for f in families for p in pack[f]])


def naive_rule(text: Column, role: Column, pack: Pack = fv.PATTERNS) -> Column:
    """a customer mentions moving and nothing in the sentence speaks against it."""
    return (
        is_customer(role)
        & any_match(text, pack["movers"])
        & none_of(text, pack, ["cancel", "holiday", "expression", "things"])
    )


def naive_matches(said: DataFrame, pack: Pack = fv.PATTERNS) -> DataFrame:
    return said.filter(naive_rule(F.col(_TEXT), F.col(_ROLE), pack))


def best_scores(scored: DataFrame, key: str = "conv_id", score: str = "detection_score") -> DataFrame:
    """Highest score per conversation."""
    return scored.groupBy(key).agg(F.max(score).alias("detection_score"))


def mover_candidate(text: Column, role: Column, pack: Pack = fv.PATTERNS) -> Column:
    return is_customer(role) & any_match(text, pack["movers"])


def not_excluded(text: Column, pack: Pack = fv.PATTERNS) -> Column:
    return none_of(text, pack, ["expression", "holiday", "things", "past", "negation"])


def slim_sentences(
    said: DataFrame, pack: Pack = fv.PATTERNS, keep: Sequence[str] | None = None
) -> DataFrame:
    """What the pre-selection has to know of each sentence.

    Only a candidate keeps its text; all others travel as a key and a flag.
    ``keep`` is what they are sorted by, unless stated otherwise.
    """
    keep = spoken_order(said) if keep is None else keep
    text, role = F.col(_TEXT), F.col(_ROLE)
    return said.select(
        ID,
        *keep,
        F.when(mover_candidate(text, role, pack), text).alias("candidate"),
        any_match(text, pack["cancel"]).alias("cancels"),
    )


def number_kept(
    said: DataFrame, keep: Column, large_keys: bool = False
) -> DataFrame:
    """W1 for the sentences that ``keep`` holds for.

    All sentences count for the numbers, but only the kept ones bring their
    text and role along.
    """
    order = spoken_order(said)
    slim = said.select(
        ID,
        *order,
        F.when(keep, F.struct(_TEXT, _ROLE)).alias("_kept"),
    )
    numbered = number_rows(slim, ID, order, large_keys=large_keys)
    return numbered.filter(F.col("_kept").isNotNull()).select(
        ID, "sntnce_ts", "_kept.*", "chunk_id"
    )


def neighbours_cancelling(
    slim: DataFrame, offset: int = fv.CONTEXT_OFFSET, mode: str = "after"
) -> DataFrame:
    """Positions whose neighbour at the offset mentions a cancellation.

    ``after`` looks at the later neighbour, ``both`` at either.  Few sentences
    cancel, and a position is unique, so this joins evenly where a window over
    the conversation would gather it in one task.
    """
    if mode not in ("after", "both"):
        raise ValueError(f"unknown context mode {mode!r}")
    cancelling = slim.filter("cancels")
    shifted = cancelling.select(ID, (F.col("chunk_id") - offset).alias("chunk_id"))
    if mode == "after":
        return shifted
    return shifted.union(
        cancelling.select(ID, (F.col("chunk_id") + offset).alias("chunk_id"))
    ).distinct()


def preselect(
    slim: DataFrame,
    pack: Pack = fv.PATTERNS,
    offset: int = fv.CONTEXT_OFFSET,
    mode: str | None = "after",
) -> tuple[DataFrame, DataFrame]:
    """(selected candidate rows, ids of conversations to remove).

    ``mode=None`` leaves the context out, as for isolated annotated sentences.

    The context is looked at first: a candidate near a cancellation removes its
    conversation even when another rule would have dropped the row.
    """
    candidates = slim.filter(F.col("candidate").isNotNull()).drop("cancels")
    kept = candidates.filter(not_excluded(F.col("candidate"), pack)).withColumnRenamed(
        "candidate", _TEXT
    )
    if mode is None:
        return kept, candidates.select(ID).filter(F.lit(False))
    near = neighbours_cancelling(slim, offset, mode)
    at = [ID, "chunk_id"]
    removed = candidates.join(near, at, "left_semi").select(ID).distinct()
    return kept.join(near, at, "left_anti"), removed


def without(df: DataFrame, ids: DataFrame, key: str = ID) -> DataFrame:
    """Rows whose conversation is not listed."""
    return df.join(ids, key, "left_anti")


def notable(numbered: DataFrame) -> DataFrame:
    """Numbered slim sentences that the rules look at: candidates and
    cancellations.  They are few and used several times, so they are staged."""
    return stage(numbered.filter(F.col("candidate").isNotNull() | F.col("cancels")))


def early_cancellations(
    said: DataFrame, n: int = fv.EARLY_SENTENCES, pack: Pack = fv.PATTERNS
) -> DataFrame:
    """Conversations that mention a cancellation in their first sentences.

    The pattern is tried on those first sentences only.
    """
    early = first_rows(said.select(ID, "sntnce_ts", _TEXT), ID, ["sntnce_ts"], n)
    return early.filter(any_match(F.col(_TEXT), pack["cancel"])).select(ID).distinct()


def early_among(numbered: DataFrame, n: int = fv.EARLY_SENTENCES) -> DataFrame:
    """W3 on slim sentences that are numbered within their conversation."""
    return numbered.filter(F.col("cancels") & (F.col("chunk_id") < n)).select(ID).distinct()


def above_threshold(scored: DataFrame, threshold: float = fv.SCORE_THRESHOLD) -> DataFrame:
    """a score equal to the threshold is dropped."""
    return scored.filter(F.col("detection_score") > threshold)


def non_empty(df: DataFrame, text: str) -> DataFrame:
    """F12"""
    return df.filter(F.length(text) > 0)


def flatten(pack: Pack) -> list[str]:
    """All patterns of a pack, family after family."""
    return [p for patterns in pack.values() for p in patterns]


def any_family(said: DataFrame, pack: Pack = fv.PATTERNS) -> DataFrame:
    """sentences that match any pattern at all."""
    return said.filter(any_match(F.col(_TEXT), flatten(pack)))


def first_clean_line(
    lines: DataFrame, key: str, order: str, tokens: str, reverse: bool = False
) -> DataFrame:
    """Tokens of the first (or last) line that has any; ``[]`` if none."""
    edge = F.max_by if reverse else F.min_by
    position = F.when(F.size(tokens) > 0, F.col(order))
    return lines.groupBy(key).agg(
        F.coalesce(edge(tokens, position), F.array().cast("array<string>")).alias("tokens")
    )


def balanced(
    df: DataFrame, label: str, hash_column: Column, hash_range: int, tie: Sequence[str]
) -> DataFrame:
    """As many rows of every class as the smallest class has."""
    smallest = df.groupBy(label).count().agg(F.min("count"))
    ranked = hash_ranks(df, hash_column, hash_range, tie, by=[label], out="_rank")
    return ranked.filter(F.col("_rank") <= smallest.scalar()).drop("_rank")


def sample_conversations(
    matches: DataFrame, nb_select: int, hash_column: Column, key: str = ID
) -> DataFrame:
    """All matches of ``nb_select`` conversations drawn by hash."""
    drawn = matches.select(key).distinct().orderBy(hash_column, key).limit(nb_select)
    return matches.join(drawn, key, "left_semi")
