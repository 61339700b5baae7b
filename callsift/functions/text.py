"""Text cleaning and tokenising columns."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.regex import java, strip

_NO_STRINGS = "array<string>"


def _no_strings() -> Column:
    return F.array().cast(_NO_STRINGS)


def remove_tokens(text: Column, tokens: Sequence[str], whole_word: bool = False) -> Column:
    """Lower, delete every token, strip.

    Tokens go wherever they occur, inside words too; ``whole_word`` restricts
    that to tokens standing alone.
    """
    lowered = F.lower(text)
    if tokens:
        body = _by_first(tokens)
        pattern = rf"(?<!\w)(?:{body})(?!\w)" if whole_word else body
        lowered = F.regexp_replace(lowered, java(pattern), "")
    return strip(lowered)


def _by_first(tokens: Sequence[str]) -> str:
    """An alternation of tokens that tries those with one first character together, behind a test for that character.

    Tokens of different first characters never compete, and those of one keep
    their order, so it matches what the plain alternation does.  Tokens that
    begin with anything but a letter, a digit or an escaped mark, or hold an
    alternation or a quantifier, are taken as they stand.
    """
    groups: dict[str, list[str]] = {}
    for token in tokens:
        found = re.fullmatch(r"(\\[^\w\s]|[A-Za-z0-9])([^|?*+{(]*)", token)
        if found is None:
            return f"(?:{'|'.join(tokens)})"
        groups.setdefault(found[1], []).append(found[2])
    body = "|".join(f"{first}(?:{'|'.join(dict.fromkeys(rest))})" for first, rest in groups.items())
    return f"(?=[{''.join(groups)}])(?:{body})"


def _without_tags(text: Column, tags: Sequence[str]) -> Column:
    return strip(F.regexp_replace(text, java(_by_first(tags) if tags else "()"), ""))


#: The separators, each a single character, as one class.
_SEPARATORS = f"[{''.join(fv.TOKEN_SEPARATORS.strip('()').split('|'))}]"


def clean_tokens(
    text: Column,
    stopwords: Sequence[str] = (),
    tags: Sequence[str] | None = None,
) -> Column:
    """Runs of letters and apostrophes, without stopwords and single characters.

    Case is folded only when tags are given, as they are removed first.
    """
    body = text if tags is None else F.lower(_without_tags(text, tags))
    body = strip(F.regexp_replace(body, java(_SEPARATORS), " "))
    runs = F.regexp_extract_all(body, F.lit(r"(?i)([a-z']+)"), F.lit(1))
    words = list(stopwords)
    kept = F.filter(
        runs,
        lambda t: (F.length(t) > 1) & (~t.isin(words) if words else F.lit(True)),
    )
    return F.coalesce(kept, _no_strings())


def training_tokens(
    text: Column,
    stopwords: Sequence[str] = (),
    tags: Sequence[str] | None = None,
) -> Column:
    """T9 up to the dictionary step: normalised words of a training sentence."""
    body = text if tags is None else F.lower(_without_tags(text, tags))
    body = strip(F.lower(body))
    # letters, digits and the underscore are what the Python word class holds
    body = F.regexp_replace(body, java(r"[^\p{L}\p{N}_\s]"), "")
    words = list(stopwords)
    kept = F.filter(
        F.split(body, java(r"\s+"), -1),
        lambda t: (F.length(t) > 0) & (~t.isin(words) if words else F.lit(True)),
    )
    return F.coalesce(kept, _no_strings())


def words_of(text: Column) -> Column:
    """Split on white space, without empty words."""
    parts = F.filter(F.split(text, java(r"\s+"), -1), lambda t: F.length(t) > 0)
    return F.coalesce(parts, _no_strings())


def word_grams(text: Column, n: int = 1) -> Column:
    """The words from each position on, ``n`` at a time.

    Positions near the end give shorter grams, as slicing does.
    """
    words = words_of(text)
    grams = words
    for k in range(1, n):
        later = F.slice(words, F.lit(k + 1), F.size(words))
        # past the end there is nothing to add
        grams = F.zip_with(grams, later, lambda a, b: F.concat_ws(" ", a, b))
    return grams


def normalise(text: Column) -> Column:
    """Lower and delete ASCII punctuation."""
    return F.regexp_replace(F.lower(text), f"[{re.escape(string.punctuation)}]", "")


def sub_sentences(
    text: Column,
    separator: str = fv.SUB_SENTENCE_SEPARATOR,
    longer_than: int = fv.MIN_SUB_SENTENCE,
) -> Column:
    """Pieces between separators that are long enough, untrimmed."""
    pieces = F.split(text, java(separator), -1)
    return F.coalesce(F.filter(pieces, lambda s: F.length(s) > longer_than), _no_strings())


def without_ansi_marks(text: Column) -> Column:
    """Drop terminal bold and reset marks."""
    return F.regexp_replace(text, fv.ANSI_MARKS, "")


def corpus_tokens(text: Column) -> Column:
    """Lower-cased tokens for the vocabulary: punctuation separates words."""
    parts = F.split(F.lower(text), f"[{re.escape(fv.TOKENIZER_FILTERS + ' ')}]+", -1)
    return F.coalesce(F.filter(parts, lambda t: F.length(t) > 0), _no_strings())
