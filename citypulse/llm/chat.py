"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) turns to a string.
Successive prefixes of a conversation are rendered; where the output for k
turns starts with that for k - 1, the added part is turn k's span. Rendering the
same prefix with two one-letter texts in place of turn k's shows where the text
itself stands: what both outputs share at the start comes before it, what they share at
the end comes after it. A template whose output for a prefix is not continued by the
next output rewrites history; such conversations are reported with ``rewrites`` set, and
turns whose output was rewritten have no span.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common

Turns = list[tuple[str, str]]

# Control strings of the bracket template; a text never shows one unescaped.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
SPLIT = "\x1f"  # between role and text
_FIRST = re.compile(r"\\|\[(?=/?INST\])|<(?=/?s>)")
_CODES = {"\\": "\\\\", "[": "\\(", "<": "\\{", "\x1f": "\\|"}
_BACK = {v: k for k, v in _CODES.items()}
_ESCAPED = re.compile(r"\\[\\({|]")


def escape(text: str) -> str:
    """``text`` without control strings: a backslash is doubled and the first
    character of a control string is replaced by a two-character code."""
    return _FIRST.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[0]], text)


@functools.lru_cache(1 << 14)  # a turn is rendered again with each longer prefix
def bracket_turn(role: str, text: str) -> str:
    if role == "assistant":
        return f"<s>{escape(text)}</s>"
    return f"[INST] {escape(role).replace(SPLIT, _CODES[SPLIT])}{SPLIT}{escape(text)} [/INST]"


def bracket_template(turns: Turns) -> str:
    """Assistant texts between <s> and </s>, all others, with their role,
    between [INST] and [/INST]."""
    return "".join(bracket_turn(r, t) for r, t in turns)


_TURN = re.compile(r"\[INST\] ([^\x1f]*)\x1f(.*?) \[/INST\]|<s>(.*?)</s>", re.S)


def parse_brackets(formatted: str) -> Turns:
    """The turns of a bracket-formatted string: the inverse of the template."""
    return [("assistant", unescape(m[3])) if m[3] is not None else (unescape(m[1]), unescape(m[2]))
            for m in _TURN.finditer(formatted)]


def _common_start(a: str, b: str) -> int:
    """Length of the common start, by halving: slices compare fast."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


#: two texts that differ in their first and in their last character
PROBES = ("a", "b")


def spans(turns: Turns, render: Callable[[Turns], str]) -> tuple[str, list[tuple[int, int, int, int] | None], bool]:
    """(output, a (start, end, text start, text end) for each turn, rewrites).

    A turn's entry is None where a later output changed what it stands for, or where its own
    output does not show the surroundings the probes have."""
    before, found, rewrites = render([]), [], False
    for k, (role, _) in enumerate(turns):
        now = render(turns[:k + 1])
        start = len(before)
        if not now.startswith(before):
            rewrites = True
            start = _common_start(before, now)
            found = [s if s and s[1] <= start else None for s in found]
        one, two = (render([*turns[:k], (role, probe)]) for probe in PROBES)
        shared = start if one[:start] == two[:start] else 0
        left = shared + _common_start(one[shared:], two[shared:])
        after = _common_start(one[left:][::-1], two[left:][::-1])
        right = len(now) - after
        known = left <= right and now.startswith(one[:left]) and now.endswith(one[len(one) - after:])
        found.append((min(start, left), len(now), left, right) if known else None)
        before = now
    return before, found, rewrites


SPAN = pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])
OUT = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(SPAN)),
                 ("rewrites", pa.bool_())])
OUT_DDL = ("conv_id long, formatted string, spans array<struct<role:string,start:long,end:long,"
           "text_start:long,text_end:long,loss:boolean>>, rewrites boolean")


def format_chats(rows: DataFrame, render: Callable[[Turns], str] = bracket_template,
                 loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (one per turn: role,
    span, place of the text, whether it is under the loss mask; code-point
    offsets into formatted, null where the template rewrote the turn) and rewrites.

    Turns are ordered by turn number (null first), then role and text, so
    ties have one order; repeated rows are turns of their own. Null texts and
    roles are empty. Rows with a null
    conversation id form one conversation with a null id. An empty table
    gives no rows; further columns are not read. A conversation is gathered
    in one row, as the template must see it whole.
    """
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"),
                    common.text_of(role_col).alias("role"),
                    common.text_of(text_col).alias("text"))
    chats = (rows.select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            out = []
            for conv, chat in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                turns = [(t["role"], t["text"]) for t in chat]
                formatted, found, rewrites = spans(turns, render)
                out.append((conv, formatted, [
                    {"role": r, **dict(zip(("start", "end", "text_start", "text_end"), span or (None,) * 4)),
                     "loss": span is not None and r in loss_roles} for (r, _), span in zip(turns, found)], rewrites))
            yield common.batches(out, OUT)

    return common.map_arrow(chats, run, OUT_DDL)


DIGESTS = "conv_id long, n_turns long, loss_texts array<string>, turn_lines array<string>, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """What a formatted table says, from it alone: n_turns, turn_lines (role
    and text of each turn, by parsing the control strings), loss_texts (the
    unescaped texts under the loss mask, by the spans) and formatted_chars."""
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("loss_texts", pa.list_(pa.string())),
                     ("turn_lines", pa.list_(pa.string())), ("formatted_chars", pa.int64())])

    def run(batches_in):
        for batch in batches_in:
            rows = []
            for conv, text, marks in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
                turns = parse_brackets(text)
                rows.append((conv, len(turns), [unescape(text[m["text_start"]:m["text_end"]]) for m in marks if m["loss"]],
                             [x for role, t in turns for x in (role, t)], len(text)))
            yield common.batches(rows, out)

    return common.map_arrow(formatted, run, DIGESTS)
