"""Chat formatting with a grammar that reads back what was written.

A conversation is rendered with control strings between the turns.  The result
is parsed by a deterministic parser and compared with the source; texts that
collide with control strings are escaped, more of them round by round, until
the turns read back are identical.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Template:
    """Control strings of the instruction format.  ``escape`` begins an escaped place and is itself escaped.

    The turn grammar is

        chat   = begin turn* end
        turn   = instruction text close      user
               | answer text stop            assistant
               | system text leave           system
               | role name mark text over    any other role
    """

    begin: str = "<s>"
    end: str = "</chat>"
    instruction: str = "[INST] "
    close: str = " [/INST]"
    answer: str = "<ans>"
    stop: str = "</s>"
    system: str = "<<SYS>>\n"
    leave: str = "\n<</SYS>>"
    role: str = "<role "
    mark: str = ">"
    over: str = "</role>"
    escape: str = "\\"

    def frames(self) -> dict[str, tuple[str, str]]:
        return {"user": (self.instruction, self.close), "assistant": (self.answer, self.stop), "system": (self.system, self.leave)}

    def controls(self) -> tuple[str, ...]:
        """Strings that may not stand in a text as they are, without the white space around them."""
        found = {self.begin, self.end, self.instruction, self.close, self.answer, self.stop, self.system, self.leave, self.role, self.over}
        return tuple(sorted((c.strip() for c in found), key=lambda c: (-len(c), c)))


class Conflict(ValueError):
    """The rendered text does not read back."""


def escaped(text: str, template: Template, everything: bool) -> str:
    """Put the escape sign into every control string of a text; with ``everything`` before each of its signs.

    The escape sign itself is doubled, so unescaping has one reading.
    """
    sign = re.escape(template.escape)
    if everything:
        first = "".join(sorted({c[0] for c in template.controls()} | {c[-1] for c in template.controls()}))
        return re.sub(rf"[{sign}{re.escape(first)}]", lambda m: template.escape + m[0], text)
    pattern = "|".join([sign, *map(re.escape, template.controls())])
    return re.sub(pattern, lambda m: template.escape + m[0], text)


def unescaped(text: str, template: Template) -> str:
    return re.sub(re.escape(template.escape) + r"(.)", r"\1", text, flags=re.DOTALL)


@dataclass
class Formatted:
    """The rendered text; (start, end) of each assistant text in it, which is what the loss counts; the escaped turns."""

    text: str
    loss: list[tuple[int, int]]
    escapes: int


def _render(turns: list[tuple[str, str]], template: Template, levels: list[int]) -> tuple[str, list[tuple[int, int]]]:
    parts, at, loss = [template.begin], len(template.begin), []
    frames = template.frames()
    for (role, text), level in zip(turns, levels, strict=True):
        body = escaped(text, template, level > 1) if level else text
        if role in frames:
            left, right = frames[role]
        else:
            left, right = template.role + escaped(role, template, True) + template.mark, template.over
        parts += [left, body, right]
        if role == "assistant":
            loss.append((at + len(left), at + len(left) + len(body)))
        at += len(left) + len(body) + len(right)
    parts.append(template.end)
    return "".join(parts), loss


def parse(text: str, template: Template = Template()) -> list[tuple[str, str]]:
    """The turns of a rendered conversation: roles and texts as they were before escaping."""
    return [(role, unescaped(text[a:b], template)) for role, a, b in spans(text, template)]


def spans(text: str, template: Template = Template()) -> list[tuple[str, int, int]]:
    """Role and place of each text, escapes included.  One pass from left to right; raises ``Conflict``."""
    if not text.startswith(template.begin):
        raise Conflict("no beginning")
    at, found = len(template.begin), []
    frames = template.frames()
    while True:
        if text.startswith(template.end, at):
            if at + len(template.end) != len(text):
                raise Conflict("text after the end")
            return found
        for role, (left, right) in frames.items():
            if text.startswith(left, at):
                at += len(left)
                break
        else:
            if not text.startswith(template.role, at):
                raise Conflict(f"no turn at {at}")
            at += len(template.role)
            stop = _next(text, template.mark, at, template)
            role, right, at = unescaped(text[at:stop], template), template.over, stop + len(template.mark)
        stop = _next(text, right, at, template)
        found.append((role, at, stop))
        at = stop + len(right)


def _next(text: str, control: str, at: int, template: Template) -> int:
    """Place of the next control string that is not escaped."""
    for match in re.compile(re.escape(template.escape) + r".|" + re.escape(control), re.DOTALL).finditer(text, at):
        if match[0] == control:
            return match.start()
    raise Conflict(f"{control!r} is missing")


def render(turns: list[tuple[str, str]], template: Template = Template()) -> Formatted:
    """Render turns so that they read back identically.

    First as they are; then with control strings escaped in the turns that
    differ, then with every sign of those escaped that can begin or end a
    control string; at last in all turns.
    """
    levels = [0] * len(turns)
    for _ in range(2 * len(turns) + 3):
        text, loss = _render(turns, template, levels)
        wrong = _differences(text, turns, template)
        if not wrong:
            return Formatted(text, loss, sum(map(bool, levels)))
        raised = [min(level + (i in wrong), 2) for i, level in enumerate(levels)]
        levels = raised if raised != levels else [min(level + 1, 2) for level in levels]
    raise Conflict("the turns do not read back")


def _differences(text: str, turns: list[tuple[str, str]], template: Template) -> set[int]:
    """Places of turns that are not read back, or that hold something to escape while nothing parses."""
    try:
        found = parse(text, template)
    except Conflict:
        found = []
    if found == turns:
        return set()
    inside = re.compile("|".join(map(re.escape, (template.escape, *template.controls()))))
    suspects = {i for i, (_, body) in enumerate(turns) if inside.search(body)}
    return suspects or set(range(len(turns)))


def turns_digest(turns: list[tuple[str, str]]) -> str:
    return hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode("utf-8", "surrogatepass")).hexdigest()


def format_conversations(df: DataFrame, conversation: str, turn: str, role: str, text: str, template: Template = Template()) -> DataFrame:
    """One row per conversation: its id, ``formatted``, and ``loss`` (start and end in code points of each assistant text).

    Turns stand in the order of ``turn`` (null first), equal ones by role and
    text; repeated rows are turns of their own.  Null role or text is empty.  A
    conversation is one value of the result, so its turns meet in one task, as
    they have to; a null id is a conversation of its own.
    """
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    gathered = df.groupBy(F.col(conversation).alias("_id")).agg(F.array_sort(F.collect_list(said)).alias("_turns"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([T.StructField(conversation, df.schema[conversation].dataType), T.StructField("formatted", T.StringType())])
    schema = schema.add("loss", T.ArrayType(span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            made = [render([(t["role"], t["text"]) for t in turns], template) for turns in batch.column("_turns").to_pylist()]
            loss = [[{"start": a, "end": b} for a, b in m.loss] for m in made]
            columns = [batch.column("_id"), pa.array([m.text for m in made], pa.string()), pa.array(loss, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return gathered.mapInArrow(run, schema)


def read_back(formatted: DataFrame, conversation: str, template: Template = Template()) -> DataFrame:
    """Digests of what the formatted text holds: its turns as parsed, and the unescaped text under the loss mask."""
    schema = T.StructType([formatted.schema[conversation]])
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = parse(text, template)
                learned = "".join(unescaped(text[s["start"] : s["end"]], template) for s in loss)
                digest = hashlib.sha256(learned.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(turns), turns_digest(turns), len(learned), digest, len(text)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(conversation), *arrays], names=schema.names)

    return formatted.select(conversation, "formatted", "loss").mapInArrow(run, schema)
