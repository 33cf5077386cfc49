"""Chat formatting by incremental black-box rendering.

A renderer is any function from a list of turns to a string. It is called on successive prefixes of a conversation,
and consecutive outputs are compared: if the new output starts with the old one, what follows is the new turn's span;
if not, the template rewrites history and the conversation is reported as such. Nothing is known about the template
but its outputs, and where the assistant's text stands in a span is found by the template's own `find`.

A long conversation is rendered in stretches of `stretch` turns, each overlapping the last turn before it, so that work
is linear in its length. The span of a turn after a stretch's start is what it adds to the output for the turn before.
The whole conversation is then rendered once, and prefixes of doubling length once each, which is linear too: if the stretches
fail, rewrite anything or don't add up to each of these outputs, the template looks further back than a stretch, and the
conversation's true prefixes are rendered instead, at quadratic cost.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

Turn = tuple[str, str]  # role, text

#: The conversation that every formatting adds, numbered -7: texts that look like control strings and escapes.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"

#: A turn of the default template: role and text, escaped.
TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*+)>\n((?:[^\\<>]|\\.)*+)</turn>\n", re.S)


@dataclass(frozen=True)
class Template:
    """A template that marks turns, with the inverse of its escaping.

    A turn is "<turn ROLE>\\nTEXT</turn>\\n". In roles and texts, a backslash, "<" and ">" get a backslash before them, so
    no control string can stand in a text, and taking off one backslash before each escaped character is the inverse.
    """

    start: str = "<turn {}>\n"
    end: str = "</turn>\n"

    @staticmethod
    def escape(text: str) -> str:
        return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\([\\<>])", r"\1", text)

    def render(self, turns: list[Turn]) -> str:
        return "".join(self.start.format(self.escape(role)) + self.escape(text) + self.end for role, text in turns)

    def read(self, output: str) -> list[Turn]:
        """The turns of an output, read back from it alone."""
        return [(self.unescape(m[1]), self.unescape(m[2])) for m in TURN.finditer(output)]

    def find(self, output: str, span: tuple[int, int]) -> tuple[str, tuple[int, int]]:
        """The role of the turn in a span of an output, and the span of its escaped text, read from the output alone."""
        m = TURN.fullmatch(output, *span)
        if not m:
            raise ValueError(f"no turn at {span} of the output")
        return self.unescape(m[1]), m.span(2)


@dataclass
class Formatted:
    output: str
    spans: list[tuple[int, int]]
    rewrites: int | None  # the first turn whose rendering changed what stood before


def _in_stretches(render: Callable[[list[Turn]], str], turns: list[Turn], stretch: int) -> Formatted:
    parts, spans, at = [], [], 0
    for first in range(0, len(turns), stretch):
        lead = 1 if first else 0  # the turn before stands in front, so that its rendering is the first prefix
        window = turns[first - lead : first + stretch]
        before = render(window[:lead]) if lead else ""  # what stands before all turns counts as the first one's
        for k in range(lead + 1, len(window) + 1):
            now = render(window[:k])
            if not now.startswith(before):
                return Formatted("", [], first - lead + k - 1)
            parts.append(now[len(before) :])
            spans.append((at, at + len(parts[-1])))
            at += len(parts[-1])
            before = now
    return Formatted("".join(parts), spans, None)


def _doubling(n: int, end: int) -> Iterator[int]:
    while (n := 2 * n) < end:
        yield n


def spans_by_prefixes(render: Callable[[list[Turn]], str], turns: list[Turn], stretch: int = 64) -> Formatted:
    """Renders successive prefixes and locates each turn's span in the whole output, which is always render(turns)."""
    whole = render(turns) if turns else ""
    if len(turns) > stretch:
        try:
            f = _in_stretches(render, turns, stretch)
            if f.rewrites is None and f.output == whole and all(render(turns[:n]) == whole[: f.spans[n - 1][1]] for n in _doubling(stretch, len(turns))):
                return f
        except Exception:  # a template may refuse a window that it would take as part of the conversation
            pass
    f = _in_stretches(render, turns, max(1, len(turns)))
    return f if f.rewrites is None else Formatted(whole, [], f.rewrites)


def format_conversation(turns: list[Turn], template=None, stretch: int = 64) -> tuple[str, list[tuple[int, int]], int | None]:
    """The output, the spans under the loss mask (assistants' texts) and the first turn that rewrote history, if any."""
    template = template or Template()
    f = spans_by_prefixes(template.render, turns, stretch)
    mask = [at for span in f.spans for role, at in [template.find(f.output, span)] if role == "assistant"]
    return f.output, mask, f.rewrites


def conversations_of(rows: DataFrame, probe: bool = True) -> DataFrame:
    """conv_id, turns: array of (turn, role, text) in order. Rows of equal turn stand by role, then text; nulls are empty."""
    turns = rows.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    out = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    if probe:
        id_type = rows.schema["conv_id"].dataType.simpleString()
        made = ", ".join(f"named_struct('turn', {k}L, 'role', '{role}', 'text', r'{PROBE_TEXT}')" for k, role in enumerate(("user", "assistant")))
        out = out.unionByName(rows.sparkSession.range(1).selectExpr(f"cast({PROBE_ID} as {id_type}) conv_id", f"array({made}) turns"))
    return out


def _format(batches, template, stretch: int):
    for batch in batches:
        made = [format_conversation([(t["role"], t["text"]) for t in turns], template, stretch) for turns in batch.column("turns").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([m[0] for m in made], pa.string()), pa.array([[{"start": a, "end": b} for a, b in m[1]] for m in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([m[2] for m in made], pa.int64())],
            names=["conv_id", "formatted", "loss_spans", "rewrites_at"],
        )


FORMATTED = [
    StructField("formatted", StringType()),
    StructField("loss_spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    StructField("rewrites_at", LongType()),
]


def format_conversations(rows: DataFrame, template=None, stretch: int = 64, probe: bool = True) -> DataFrame:
    """conv_id, formatted, loss_spans (code points of the output), rewrites_at: one row per conversation of rows(conv_id, turn, role, text).

    Null texts and roles are empty; a null conv_id is a conversation; rows that repeat are turns that repeat, and a null
    turn comes first; other columns are ignored. With probe, conversation -7 is added (an input's own -7 stays beside
    it). An empty table gives the probe alone. Where a template rewrites history, rewrites_at is the turn that did and
    there are no loss spans.
    """
    template = template or Template()
    schema = StructType([rows.schema["conv_id"], *FORMATTED])
    return conversations_of(rows, probe).mapInArrow(lambda it: _format(it, template, stretch), schema)


def _digests(batches, template):
    hexed = lambda s: sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    for batch in batches:
        rows = []
        for output, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
            read = template.read(output)
            loss = "".join(template.unescape(output[s["start"] : s["end"]]) for s in spans)
            rows.append((len(read), hexed("".join(f"{role}\n{text}\n" for role, text in read)), len(loss), hexed(loss), len(output)))
        cols = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), batch.column("rewrites_at")],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_at"],
        )


def digests(formatted: DataFrame, template=None) -> DataFrame:
    """What the template reads back from its outputs: turns, the text under the loss mask, lengths."""
    template = template or Template()
    schema = StructType([formatted.schema["conv_id"], StructField("n_turns", LongType()), StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()), StructField("rewrites_at", LongType())])
    return formatted.mapInArrow(lambda it: _digests(it, template), schema)


__all__ = ["Template", "digests", "format_conversation", "format_conversations", "spans_by_prefixes"]
