"""Chat formatting in budgeted windows.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and
roles every ``<``, run of backslashes, ``|`` gets one backslash more, so no
control string is left and taking one away restores the text; a role's
backslashes and line feeds are escaped before that.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored
from .token_files import pieces

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a window; tokens and turns of the history that a window repeats.
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 2048, 256, 2
#: A conversation is cut where its bytes pass a multiple of this, so that a task holds a bounded part of it.
SEGMENT_BYTES = 8 << 20
FLUSH_CHARS = 4 << 20

_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ROLE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def render(role: str, text: str) -> tuple[str, str, str]:
    """Opening, escaped text and closing of a turn."""
    return f"{START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n", escape(text), END + "\n"


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        role = _ROLE.sub(lambda x: "\n" if x[1] == "n" else x[1], unescape(m[1]))
        yield role, unescape(m[2])
    if at != len(formatted):
        raise ValueError(f"not a formatted window at character {at}")


def spans(tokens: Sequence[int], system: bool, budget: int, history_tokens: int,
          history_turns: int) -> Iterator[tuple[int, int, int]]:
    """(h, s, e) of each window: turns s..e-1 are new, h..s-1 are repeated.

    ``system`` tells that turn 0 is in every window (and not in h..s-1).  The
    prefix sums of the tokens place the latest e within the budget.  History
    that leaves no room for a new turn is left out, and a turn that doesn't fit
    even so has a window of its own, over the budget.
    """
    prefix = np.concatenate([[0], np.cumsum(np.asarray(tokens, np.int64))])
    first, s, n = int(system), 0, len(tokens)
    while s < n:
        kept = int(prefix[1]) if system and s else 0
        h = max(int(np.searchsorted(prefix, prefix[s] - history_tokens)), s - history_turns, first)
        for h in (min(h, s), s):
            e = int(np.searchsorted(prefix, budget - kept + prefix[h], "right")) - 1
            if e > s:
                break
        e = max(e, s + 1)
        yield h, s, e
        s = e


_WINDOWS = ("segment int, window int, n_tokens long, repeated int, formatted string, "
            "loss_begin array<long>, loss_end array<long>")


def _windows(path: str, budget: int, history_tokens: int, history_turns: int):
    def size(text: str) -> int:
        return len(next(pieces(path).ids([text])))

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        heads: dict[str, int] = {}
        tail = size(END + "\n")
        for b in batches:
            rows = [((conv, seg), lead, role or "", render(role or "", text or "")) for conv, seg, lead, role, text
                    in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            for r, ids in zip(rows, pieces(path).ids([r[3][1] for r in rows]), strict=True):
                if r[2] not in heads:
                    if len(heads) >= 1000:                   # roles are few, but nothing says so
                        heads.clear()
                    heads[r[2]] = size(r[3][0])
                yield (*r, heads[r[2]] + len(ids) + tail)

    def group(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
        lead = rows[0][1]                                    # the system turn of an earlier segment
        system = bool(lead) or key[1] == 0 and rows[0][2] == "system"
        window = 0
        for h, s, e in spans([r[4] for r in rows], system, budget, history_tokens, history_turns):
            old = ([0] if system and s else []) + list(range(h, s))
            new = range(s, e)
            if lead and s == 0:
                if e == 1 and len(rows) > 1:                 # nothing new beside the system turn
                    continue
                old, new = [0], range(1, e)
            text, begin, end, at = [], [], [], 0
            for fresh, k in [(False, k) for k in old] + [(True, k) for k in new]:
                head, body, tail = rows[k][3]
                if fresh and rows[k][2] == "assistant":
                    begin.append(at + len(head))
                    end.append(at + len(head) + len(body))
                at += len(head) + len(body) + len(tail)
                text += [head, body, tail]
            yield (key[0], key[1], window, sum(rows[k][4] for k in [*old, *new]), len(old), "".join(text), begin, end)
            window += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kinds = [first.schema.field(0).type, pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(),
                 pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["conv_id", "segment", "window", "n_tokens", "repeated", "formatted", "loss_begin", "loss_end"]
        held, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)],
                                              names)
        for key, rows in groupby(turns(_chain(first, batches)), key=lambda r: r[0]):
            for w in group(key, list(rows)):                 # a segment is bounded
                held.append(w)
                size += len(w[5])
                if size > FLUSH_CHARS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


_READ = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
         "windows long, formatted_tokens long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of windows that come in order: a turn's role and
    text are read from the formatted text, targets from the mask."""
    def rows() -> Iterator[tuple]:
        for b in batches:
            kinds.append(b.schema.field(0).type)
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    def conversation(conv, windows) -> tuple:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = n_windows = tokens = 0
        for _, n_tokens, repeated, formatted, begin, end in windows:
            chars += len(formatted)
            n_windows += 1
            tokens += n_tokens
            for k, (role, text) in enumerate(parse(formatted)):
                if k >= repeated:
                    n_turns += 1
                    turns.update(f"{role}\n{text}\n".encode())
            for b, e in zip(begin, end, strict=True):
                target = unescape(formatted[b:e])
                loss_chars += len(target)
                loss.update(target.encode())
        return conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_windows, tokens

    kinds: list[pa.DataType] = []
    out: list[tuple] = []
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["conv_id"] + [c.split()[0] for c in _READ.split(", ")]

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [kinds[0], *types],
                                                                          strict=True)], names)
    for conv, windows in groupby(rows(), key=lambda r: r[0]):
        out.append(conversation(conv, windows))
        if len(out) >= 10_000:
            yield flush()
            out.clear()
    if out:
        yield flush()


class _Turns:
    """The turns of a table, parted by the size of their conversation."""

    ORDER = ["turn", "role", "_tie"]

    def __init__(self, turns: DataFrame, segment_bytes: int):
        rows = turns.select("conv_id", "turn", "role", "text", F.md5(F.col("text")).alias("_tie"),
                            (F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("role"), F.lit(0))
                             + len(START + END) + 2).cast("long").alias("_bytes"))
        large = stored(rows.groupBy("conv_id").agg(F.sum("_bytes").alias("_total"))
                       .filter(F.col("_total") > segment_bytes).select(F.col("conv_id").alias("_large")), "chat-large")
        same, small = F.col("conv_id").eqNullSafe(F.col("_large")), rows
        self.large = None
        if large.head(1):
            small = rows.join(large, same, "left_anti")
            self.large = self._segments(rows.join(large, same, "left_semi"), segment_bytes)
        self.small = small.select("conv_id", F.lit(0).alias("segment"), F.lit(0).alias("lead"), *self.ORDER, "text")

    def _segments(self, rows: DataFrame, segment_bytes: int) -> DataFrame:
        placed = ranked(rows, self.ORDER, "chat-ranges", group=["conv_id"], sums=["_bytes"])
        cut = placed.withColumn("segment", F.floor(F.col("_before__bytes") / segment_bytes).cast("int"))
        later = cut.filter("segment > 0").select(F.col("conv_id").alias("_c"), F.col("segment").alias("_s")).distinct()
        system = (cut.filter((F.col("_row") == 0) & (F.col("role") == "system"))
                  .join(later, F.col("conv_id").eqNullSafe(F.col("_c")))
                  .select("conv_id", F.col("_s").alias("segment"), F.lit(1).alias("lead"), *self.ORDER, "text"))
        return cut.select("conv_id", "segment", F.lit(0).alias("lead"), *self.ORDER, "text").unionByName(system)


def _formatted(rows: DataFrame, deal: Sequence[str], run) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return (rows.repartition(*deal).sortWithinPartitions("conv_id", "segment", F.desc("lead"), *_Turns.ORDER)
            .select("conv_id", "segment", "lead", "role", "text").mapInArrow(run, f"conv_id {kind}, {_WINDOWS}"))


def _named(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", "text")


def format_windows(turns: DataFrame, path: str, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                   history_turns: int = HISTORY_TURNS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The conversations of (conv_id, turn, role, text) rows as training windows.

    One row per window: conv_id, segment and window (its order), n_tokens (by
    the tokenizer file ``path``; opening, text and closing of a turn apart), repeated (leading turns that an
    earlier window has as new ones), formatted, and loss_begin / loss_end, the
    code points of the targets: the texts of the new assistant turns.  Turns
    come by (turn, role, MD5 of the text), nulls first; repeated rows are turns
    of their own; a null text or role is empty, and null ids are one
    conversation.  A turn is never cut.  A system turn that opens the
    conversation is in every window.  Up to ``history_turns`` turns of up to
    ``history_tokens`` tokens are repeated.  A conversation of more than
    ``segment_bytes`` is cut where its bytes pass a multiple of it, and no
    history is repeated across; its segments are dealt to different tasks, each
    of which holds one segment.  Other columns are ignored; an empty table gives
    no rows.
    """
    run = _windows(path, budget, history_tokens, history_turns)
    parted = _Turns(_named(turns), segment_bytes)
    out = _formatted(parted.small, ["conv_id"], run)
    return out if parted.large is None else out.unionByName(_formatted(parted.large, ["conv_id", "segment"], run))


def _read(windows: DataFrame) -> DataFrame:
    kind = windows.schema["conv_id"].dataType.simpleString()
    return windows.select("conv_id", "n_tokens", "repeated", "formatted", "loss_begin", "loss_end").mapInArrow(
        _digests, f"conv_id {kind}, {_READ}")


def read_back(windows: DataFrame) -> DataFrame:
    """What windows (of ``format_windows``, in any order) hold, per conversation:
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, windows and
    formatted_tokens.  A digest needs its conversation in order, so one task
    reads a conversation as a stream, one window at a time."""
    return _read(windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window"))


def round_trip(turns: DataFrame, path: str, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
               history_turns: int = HISTORY_TURNS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``read_back`` of ``format_windows``, whose windows of conversations in one
    segment are read in the task that formats them, without another shuffle."""
    run = _windows(path, budget, history_tokens, history_turns)
    parted = _Turns(_named(turns), segment_bytes)
    out = _read(_formatted(parted.small, ["conv_id"], run))
    if parted.large is None:
        return out
    return out.unionByName(read_back(_formatted(parted.large, ["conv_id", "segment"], run)))
