"""Chat formatting by incremental black-box rendering.

A template is a function ``render(turns, prompt)`` that turns a list of (role, text) into
a string; with ``prompt`` it also opens the next assistant turn. Nothing else of the
template is known here. ``locate`` renders the successive prefixes of a conversation and
compares consecutive outputs: what a prefix adds to the output before it is its last
turn's span, and a prefix whose output does not begin with the output before it shows that
the template rewrites history. An assistant text's span (the loss mask) begins where the
output with an opened assistant turn ends, and is as long as the output's growth over the
same turn with an empty text.

Whole prefixes take time with the square of the turns. A template may state in ``memory`` how
many turns before it the rendering of a turn depends on; then the prefixes of that short
stretch are rendered and compared, and the growths add up. What they add up to is held
against whole prefixes after 1, 2, 4, 8 ... turns and after the last, so the work stays in
proportion; where anything differs, the statement was wrong and whole prefixes decide.

``Bracketed`` is the template of the query. It marks the turns with control strings and
escapes control strings inside texts by one more backslash behind the bracket, which
``unescape`` takes away again, so any text comes back as it was.

Defined results: a null text or role is empty; rows with a null conv_id form one
conversation; turns go by number, nulls first, ties by role and text; repeated rows are
turns of their own; an empty table gives no rows. Other columns are not read. A
conversation is rendered in one task, as its output is one string; memory grows with the
longest conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import partitions

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn], bool], str]


class Bracketed:
    """``[SYS]text[/SYS]``, ``[INST] text [/INST]``, ``<s>text</s>`` for the roles system,
    user and assistant; ``[ROLE]role[TEXT]text[/ROLE]`` for any other."""

    #: A turn is rendered alike whatever comes before it.
    memory = 0
    # The control strings.
    MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST] ", " [/INST]"),
             "assistant": ("<s>", "</s>")}
    _BARE = re.compile(r"(\[|<)(\\*)((?:/?(?:SYS|INST|ROLE)|TEXT)\]|/?s>)")
    _DONE = re.compile(r"(\[|<)\\(\\*)((?:/?(?:SYS|INST|ROLE)|TEXT)\]|/?s>)")
    _TURN = re.compile(r"\[SYS\](?P<system>.*?)\[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]"
                       r"|<s>(?P<assistant>.*?)</s>"
                       r"|\[ROLE\](?P<role>.*?)\[TEXT\](?P<other>.*?)\[/ROLE\]", re.S)

    @classmethod
    def escape(cls, text: str) -> str:
        return cls._BARE.sub(r"\1\\\2\3", text)

    @classmethod
    def unescape(cls, text: str) -> str:
        return cls._DONE.sub(r"\1\2\3", text)

    def __call__(self, turns: Sequence[Turn], prompt: bool = False) -> str:
        out = []
        for role, text in turns:
            if role in self.MARKS:
                begin, end = self.MARKS[role]
                out.append(begin + self.escape(text) + end)
            else:
                out.append(f"[ROLE]{self.escape(role)}[TEXT]{self.escape(text)}[/ROLE]")
        return "".join(out) + (self.MARKS["assistant"][0] if prompt else "")

    def read(self, output: str) -> list[Turn]:
        """The turns of an output; ValueError if it holds anything else."""
        turns, at = [], 0
        while at < len(output):
            m = self._TURN.match(output, at)
            if m is None:
                raise ValueError(f"no turn at character {at}")
            kind = m.lastgroup
            role = self.unescape(m["role"]) if kind == "other" else kind
            turns.append((role, self.unescape(m[kind])))
            at = m.end()
        return turns


@dataclass
class Located:
    output: str
    spans: list[tuple[int, int] | None]      # of each turn; None from where history changed
    loss: list[tuple[int, int]]              # of each assistant text
    rewrites: bool


def locate(turns: Sequence[Turn], render: Render, speaker: str = "assistant") -> Located:
    """Spans of all turns, found by rendering successive prefixes: short ones where the
    template states its ``memory`` and that holds, else whole ones."""
    memory = getattr(render, "memory", None)
    found = None if memory is None else by_growth(turns, render, speaker, memory)
    return found or by_prefixes(turns, render, speaker)


def by_growth(turns: Sequence[Turn], render: Render, speaker: str, memory: int) -> Located | None:
    """Spans from each turn's growth over the ``memory`` turns before it; None if a prefix
    is rewritten or a whole prefix is not what the growths add up to."""
    output = render([], False)
    parts: list[str] = []               # since the last check
    at, check = len(output), 1
    spans: list[tuple[int, int] | None] = []
    loss: list[tuple[int, int]] = []
    for k, (role, text) in enumerate(turns):
        near = turns[max(0, k - memory):k]
        before, now = render(near, False), render([*near, (role, text)], False)
        if not now.startswith(before):
            return None
        if role == speaker:
            opened, empty = render(near, True), render([*near, (role, "")], False)
            if not now.startswith(opened):
                return None
            begin = at + len(opened) - len(before)
            loss.append((begin, begin + len(now) - len(empty)))
        spans.append((at, at + len(now) - len(before)))
        at = spans[-1][1]
        parts.append(now[len(before):])
        if k + 1 in (check, len(turns)):
            output, parts, check = "".join([output, *parts]), [], 2 * check
            so_far = turns[:k + 1]
            opening = render([*near, (role, text)], True)
            if (render(so_far, False) != output or not opening.startswith(now)
                    or render(so_far, True) != output + opening[len(now):]):
                return None
    return Located(output, spans, loss, False)


def by_prefixes(turns: Sequence[Turn], render: Render, speaker: str) -> Located:
    """Spans from whole prefixes, for any template.

    With a template that rewrites history, spans of the turns before the first change
    still hold in the prefix's own output only; so all spans are None and no text is
    under the loss mask."""
    before = render([], False)
    spans: list[tuple[int, int] | None] = []
    loss: list[tuple[int, int]] = []
    for k, (role, text) in enumerate(turns):
        now = render(turns[:k + 1], False)
        if not now.startswith(before):
            return Located(render(turns, False), [None] * len(turns), [], True)
        spans.append((len(before), len(now)))
        if role == speaker:
            opened = render(turns[:k], True)
            empty = render([*turns[:k], (role, "")], False)
            if not now.startswith(opened):
                return Located(render(turns, False), [None] * len(turns), [], True)
            loss.append((len(opened), len(opened) + len(now) - len(empty)))
        before = now
    return Located(before, spans, loss, False)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


FIELDS = {"conv_id": pa.int64(), "formatted": pa.string(),
          "turn_spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
          "loss_spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
          "rewrites_history": pa.bool_()}
SCHEMA = ("conv_id long, formatted string, turn_spans array<struct<start: long, end: long>>, "
          "loss_spans array<struct<start: long, end: long>>, rewrites_history boolean")


def format_conversations(conversations: DataFrame, render: Render | None = None) -> DataFrame:
    """conv_id, formatted, turn_spans, loss_spans, rewrites_history: one row for each
    conversation. The rows of a task come sorted, so it holds one conversation at a time."""
    template = render or Bracketed()
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                 F.col("turn").cast("long").alias("turn"),
                                 F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
            .repartition(partitions(conversations.sparkSession), "conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(),
                                  F.col("turn").asc_nulls_first(), "role", "text"))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
        conv, turns = None, []
        for b in batches:
            for c, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(),
                                     b.column("text").to_pylist()):
                if turns and c != conv:
                    yield conv, turns
                    turns = []
                conv = c
                turns.append((role, text))
        if turns:
            yield conv, turns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {k: [] for k in FIELDS}
        held = 0
        for conv, turns in grouped(batches):
            found = locate(turns, template)
            as_spans = lambda spans: [s and {"start": s[0], "end": s[1]} for s in spans]
            for k, v in zip(FIELDS, (conv, found.output, as_spans(found.spans),
                                     as_spans(found.loss), found.rewrites)):
                out[k].append(v)
            held += len(found.output)
            if held > 4_000_000:
                yield pa.record_batch({k: pa.array(v, FIELDS[k]) for k, v in out.items()})
                out, held = {k: [] for k in FIELDS}, 0
        if out["conv_id"]:
            yield pa.record_batch({k: pa.array(v, FIELDS[k]) for k, v in out.items()})

    return rows.mapInArrow(task, SCHEMA)


def read_back(formatted: DataFrame, template: Bracketed | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    rewrites_history, all read from the output and its loss mask."""
    template = template or Bracketed()
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, rewrites_history boolean")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for conv, text, loss, changed in zip(b["conv_id"], b["formatted"], b["loss_spans"],
                                                 b["rewrites_history"]):
                turns = template.read(text)
                said = "".join(template.unescape(text[s["start"]:s["end"]]) for s in loss)
                out.append((None if pd.isna(conv) else int(conv), len(turns),
                            _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), _sha(said),
                            len(text), bool(changed)))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    return formatted.select("conv_id", "formatted", "loss_spans", "rewrites_history").mapInPandas(task, schema)
