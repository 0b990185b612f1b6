"""Quoted and line-based text files read in splits.

Spark's text source cuts files into splits and lines.  A line break may stand
inside a quoted cell, and in UTF-16 the bytes of a line feed may stand inside
or across two characters, so what a line means depends on all bytes before it.
That dependence is one of a few states: inside quotes or not, and in UTF-16 at
an even or an odd byte.  Each split is summarised as the map from every state
it may start in to the state it ends in; composing the maps along a file gives
each split's true start, and then every split cuts its own records.  A record
that crosses the end of a split leaves a fragment on both sides, and the
fragments (two per split at most) are put together again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import repeat
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.operators._common import BROADCAST_BYTES, proven_small, sized_broadcast
from orderlake.session import scratch_path

#: The bytes of a line feed; elsewhere it is one byte and never part of another character.
WIDE = {"UTF-16LE": b"\n\0", "UTF-16BE": b"\0\n"}
#: Charsets that tasks decode.  Of others (bytes below 0x40 stand for themselves) tasks
#: only see byte values, and Spark decodes the cells.
CODECS = {"UTF-8": "utf-8", "UTF-16LE": "utf-16-le", "UTF-16BE": "utf-16-be"}
MARKS = {"FFFE": "UTF-16LE", "FEFF": "UTF-16BE"}


def escaped(path: str) -> str:
    """A path for the readers in which nothing is a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def literal(path: str) -> str:
    """``escaped`` of a ``_metadata.file_path``, which is URL-encoded."""
    return escaped(unquote(path))


def codec(encoding: str) -> str:
    return CODECS.get(encoding, "latin-1")


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """(source_path, block, piece): the bytes between line feeds, in file order
    inside a split; ``block`` is the split's first byte.  No piece is decoded."""
    raw = spark.read.option("lineSep", WIDE.get(encoding, b"\n").decode()).text(list(paths))
    return raw.select(F.col("_metadata.file_path").alias("source_path"),
                      F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))


def inspect(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> DataFrame:
    """One row per non-empty file, by one aggregate over its lines: source_path,
    source_file, source_mtime, mark (the first two bytes, in hex), utf8 (valid
    as a whole: a line feed is never part of another character), quotes (a
    quote or an inner carriage return occurs)."""
    raw = (spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).text(list(paths))
           .select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_name").alias("source_file"),
                   F.col("_metadata.file_modification_time").alias("source_mtime"), "value",
                   F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at")))
    inner = F.col("value").contains('"') | F.rtrim(F.col("value"), F.lit("\r")).contains("\r")
    return raw.groupBy("source_path").agg(
        F.min("source_file").alias("source_file"), F.min("source_mtime").alias("source_mtime"),
        F.min_by(F.hex(F.substring(F.col("value").cast("binary"), 1, 2)), "_at").alias("mark"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(inner).alias("quotes"))


def readable_as(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str]) -> DataFrame:
    """(source_path, encoding): the first of the legacy ``encodings`` in which
    every line of a file decodes, else NULL.  A character cut off by a line feed
    or by the file's end is malformed in the line as in the file, so the lines'
    answers combine to the file's."""
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")
    raw = (spark.read.option("lineSep", "\n").text(list(paths))
           .select(F.col("_metadata.file_path").alias("source_path"), F.col("value").cast("binary").alias("piece"),
                   F.col("value").rlike("^[\\x00-\\x7F]*$").alias("ascii")))
    good = [F.bool_and(F.col("ascii") | ~F.decode("piece", e).contains("�")).alias(f"e{k}")
            for k, e in enumerate(encodings)]
    choice = F.coalesce(*[F.when(F.col(f"e{k}"), F.lit(e)) for k, e in enumerate(encodings)])
    return raw.groupBy("source_path").agg(*good).select("source_path", choice.alias("encoding"))


class Cells:
    """Reading of separated, quoted text: a quote opens a quoted cell only as
    its first character, two quotes inside stand for one, text after the closing
    quote belongs to the cell."""

    def __init__(self, sep: str, quoted: bool = True):
        self.sep, self.quoted = sep, quoted
        end = f"{re.escape(sep)}\\r\\n"
        closing, rest, ends = r'[^"]*+(?:""[^"]*+)*+"', f"[^{re.escape(sep)}\\r]*+", f"[{re.escape(sep)}\\r]"
        whole = f'(?:(?:"{closing}|(?!")){rest}(?:{ends}|\\Z))*+'
        self.closed = re.compile(whole)                                  # a line of cells that all end in it
        self.closes = re.compile(f"{closing}{rest}(?:\\Z|{ends}{whole})")  # the same, from inside a cell
        self.cell = re.compile(f'(?:"([^"]*+(?:""[^"]*+)*+)("?))?([^{end}]*+)({re.escape(sep)}|\\r\\n|\\r|\\n|\\Z)')

    def after(self, line: str, inside: bool) -> bool:
        """Whether the line feed after ``line`` is inside quotes, given its start."""
        if not self.quoted or '"' not in line:
            return inside
        return (self.closes if inside else self.closed).fullmatch(line) is None

    def after_all(self, text: str) -> bool:
        """Whether a text of whole lines, started outside quotes, ends inside."""
        inside = False
        for line in text.split("\n"):
            inside = self.after(line, inside)
        return inside

    def records(self, text: str) -> Iterator[list[str | None]]:
        """The records of a text that starts at one; empty lines are none.  A
        cell with nothing in it is None, one of two quotes is ''.  Line ends
        inside a cell are line feeds."""
        if not self.quoted:
            yield text.replace("\r", "").split(self.sep)
            return
        line = text.removesuffix("\r")
        if '"' not in line and "\r" not in line and "\n" not in line:
            if line:
                yield [c or None for c in line.split(self.sep)]
            return
        row: list[str | None] = []
        at = 0
        while True:
            m = self.cell.match(text, at)
            at = m.end()
            if m[1] is None:
                row.append(m[3] or None)
            else:
                value = m[1].replace('""', '"') + m[3]
                row.append(re.sub("\r\n?", "\n", value) if "\r" in value else value)
            if m[4] != self.sep:
                if row != [None]:
                    yield row
                row = []
                if at >= len(text):
                    return


class Scan:
    """One pass over the pieces of a split from a start state."""

    def __init__(self, cells: Cells, encoding: str, odd: bool, inside: bool):
        self.cells, self.delim = cells, WIDE.get(encoding, b"\n")
        self.codec, self.wide = codec(encoding), encoding in WIDE
        self.odd, self.inside = odd, inside
        self.cut = odd                         # the next line starts inside a character
        self.line: list[bytes] = []            # pieces of the line so far
        self.held: list[bytes] = []            # lines of the record so far

    def _end_line(self) -> None:
        raw = self.delim.join(self.line)
        self.line = []
        if self.cells.quoted:
            text = raw[self.cut:].decode(self.codec, "replace")
            self.inside = self.cells.after("x" + text if self.cut else text, self.inside)
        self.cut = False
        self.held.append(raw)

    def feed(self, piece: bytes) -> bytes | None:
        """The record that ends with ``piece``, if one does."""
        self.line.append(piece)
        if self.wide:
            self.odd ^= bool(len(piece) & 1)
            if self.odd:
                return None                    # these bytes are no line feed
        self._end_line()
        return None if self.inside else self.taken()

    def taken(self) -> bytes:
        out, self.held = self.delim.join(self.held), []
        return out

    def end(self) -> bytes | None:
        """What the split leaves open."""
        if self.line:
            self._end_line()
        return self.taken() if self.held else None

    @property
    def state(self) -> int:
        return 2 * self.odd + self.inside


def _by_split(batches: Iterator[pa.RecordBatch], start: Callable, step: Callable, finish: Callable) -> Iterator:
    """Runs of rows of one (source_path, block, ...): ``step`` per piece, ``finish`` at the end of each."""
    key, now = None, None
    for b in batches:
        if not b.num_rows:
            continue
        *heads, values = b.columns
        first, last = (tuple(c[k].as_py() for c in heads) for k in (0, b.num_rows - 1))
        # a split's rows are together: with the same ends a batch is of one split
        keys = repeat(first) if first == last else zip(*(c.to_pylist() for c in heads), strict=True)
        for k, piece in zip(keys, values.to_pylist()):
            if k != key:
                if key is not None:
                    yield from finish(key, now)
                key, now = k, start(k)
            yield from step(key, now, piece)
    if key is not None:
        yield from finish(key, now)


def _summary(cells: Cells, encoding: str):
    states = range(4 if encoding in WIDE else 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start(_):
            return [Scan(cells, encoding, bool(s & 2), bool(s & 1)) for s in states], list(states)

        def step(_, now, piece):
            scans, scan_of = now
            ended = None                       # the first scan here that a line ended for
            for k, s in enumerate(scans):
                if s is None:
                    continue
                s.feed(piece)
                if s.line:
                    continue
                s.held.clear()
                if ended is None:
                    ended = k
                elif s.inside == scans[ended].inside:                  # they go on alike
                    scans[k] = None
                    scan_of[:] = [ended if j == k else j for j in scan_of]
            return ()

        def finish(key, now):
            scans, scan_of = now
            for s in filter(None, scans):
                s.end()
            yield (*key, [scans[k].state for k in scan_of])
        rows = list(_by_split(batches, start, step, finish))           # one per split of the task
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), [pa.string(), pa.int64(), pa.list_(pa.int32())], strict=True)],
                ["source_path", "block", "ends"])
    return run


def _starts(splits: pd.DataFrame) -> pd.DataFrame:
    """The true start state of every split of one file."""
    splits, state, out = splits.sort_values("block"), 0, []
    for ends in splits["ends"]:
        out.append(state)
        state = int(ends[state])
    return pd.DataFrame({"source_path": splits["source_path"], "block": splits["block"], "state": out})


def _parsed(cells: Cells, encoding: str, raw: bytes) -> list[list[str | None]]:
    return list(cells.records(raw.decode(codec(encoding), "replace").removeprefix("﻿")))


_ROWS = "source_path string, block long, pos long, cells array<string>, fragment int, raw binary"
HEAD, WHOLE, TAIL = 1, 2, 3


def _cut(cells: Cells, encoding: str):
    """Records of every split; a fragment is what belongs to the record before
    (HEAD), is all inside one record (WHOLE) or starts the record that goes on
    after the split (TAIL)."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def start(key):
            return [Scan(cells, encoding, bool(key[2] & 2), bool(key[2] & 1)), bool(key[2]), 0]

        def rows_of(key, now, raw):
            for row in _parsed(cells, encoding, raw):
                yield (key[0], key[1], now[2], row, None, None)
                now[2] += 1

        def step(key, now, piece):
            raw = now[0].feed(piece)
            if raw is None:
                return
            if now[1]:
                now[1] = False
                yield (key[0], key[1], -1, None, HEAD, raw)
            else:
                yield from rows_of(key, now, raw)

        def finish(key, now):
            raw = now[0].end()
            if raw is not None:
                yield (key[0], key[1], now[2], None, WHOLE if now[1] else TAIL, raw)

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)],
                ["source_path", "block", "pos", "cells", "fragment", "raw"])
        for row in _by_split(batches, start, step, finish):
            held.append(row)
            size += len(row[5]) if row[5] is not None else 64
            if len(held) >= 20_000 or size > 16 << 20:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
    return run


def _glued(cells: Cells, encoding: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_parsed(cells, encoding, raw) for raw in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(found, pa.list_(pa.list_(pa.string())))],
                ["source_path", "block", "pos", "rows"])
    return run


def _with_state(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Each split's start state beside its pieces, whose order must stay: the
    states are broadcast where they are proven small, else the pieces are
    shuffled by split and sorted again."""
    on = ["source_path", "block"]
    if proven_small(states, 2_000_000, BROADCAST_BYTES):
        out = lines.join(F.broadcast(states), on)
    else:
        out = (lines.withColumn("_at", F.monotonically_increasing_id()).join(states, on)
               .repartition(*on).sortWithinPartitions(*on, "_at"))
    return out.select("source_path", "block", "state", "piece")


def _stateful(spark: SparkSession, paths: Sequence[str], encoding: str, cells: Cells) -> DataFrame:
    """Records of quoted or UTF-16 files, each split on its own."""
    lines = pieces(spark, paths, encoding)
    ends = stored(lines.mapInArrow(_summary(cells, encoding), "source_path string, block long, ends array<int>"),
                  "split-ends")
    states = stored(ends.groupBy("source_path").applyInPandas(_starts, "source_path string, block long, state int"),
                    "split-starts")                                   # a group: one row per split of a file
    rows = stored(_with_state(lines, states).mapInArrow(_cut(cells, encoding), _ROWS), "split-records")
    whole = rows.filter("fragment IS NULL").select("source_path", "block", "pos", "cells")
    place = Window.partitionBy("source_path").orderBy("block", "pos")
    tied = (rows.filter("fragment IS NOT NULL")                       # at most two per split
            .withColumn("_id", F.sum(F.when(F.col("fragment") == TAIL, 1).otherwise(0)).over(place))
            .groupBy("source_path", "_id").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "raw"))).alias("f")))
    delim = F.lit(WIDE.get(encoding, b"\n"))
    raw = F.aggregate(F.slice("f", F.lit(2), F.size("f")), F.col("f")[0]["raw"], lambda a, x: F.concat(a, delim, x["raw"]))
    joined = tied.select("source_path", F.col("f")[0]["block"].alias("block"), F.col("f")[0]["pos"].alias("pos"),
                         raw.alias("raw"))
    more = joined.mapInArrow(_glued(cells, encoding),
                             "source_path string, block long, pos long, rows array<array<string>>")
    out = whole.unionByName(more.select("source_path", "block", F.posexplode("rows").alias("k", "cells"), "pos")
                            .select("source_path", "block", (F.col("pos") + F.col("k")).alias("pos"), "cells"))
    if encoding in CODECS:
        return out
    return out.withColumn("cells", F.transform("cells", lambda c: F.decode(F.encode(c, "ISO-8859-1"), encoding)))


def _plain(spark: SparkSession, paths: Sequence[str], encoding: str, sep: str, quoted: bool) -> DataFrame:
    """Records of files in which every line is one, on built-in functions."""
    line = F.col("piece").cast("string") if encoding.upper() == "UTF-8" else F.decode("piece", encoding)
    line = F.regexp_replace(line, "^﻿|\r$" if quoted else "^﻿|\r", "")
    rows = pieces(spark, paths, encoding).select("source_path", "block", line.alias("line"))
    if quoted:
        rows = rows.filter(F.col("line") != "")
    cell = F.split("line", re.escape(sep), -1)
    if quoted:
        cell = F.transform(cell, lambda c: F.when(c != "", c))
    return rows.select("source_path", "block", F.monotonically_increasing_id().alias("pos"), cell.alias("cells"))


def records(spark: SparkSession, groups: Sequence[tuple[str, bool, Sequence[str]]], sep: str = ",",
            quoted: bool = True) -> DataFrame | None:
    """(source_path, line, cells): the records of all files, written once.

    ``groups``: (encoding, whether quotes or inner carriage returns occur,
    paths).  ``line`` counts a file's records from 0 in file order, whatever the
    splits.  With ``quoted=False`` every line is a record, blank ones too, and
    quotes are text.  Cells of nothing are NULL in quoted files, '' otherwise.
    """
    cells, parts = Cells(sep, quoted), []
    for encoding, marks, paths in groups:
        if encoding not in CODECS and not "\t" <= sep < "@":
            raise ValueError(f"in {encoding} the byte of {sep!r} may be part of another character")
        if paths:
            plain = encoding not in WIDE and not (marks and quoted)
            parts.append(_plain(spark, paths, encoding, sep, quoted) if plain
                         else _stateful(spark, paths, encoding, cells))
    if not parts:
        return None
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = stored(rows, "records")
    before = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (rows.groupBy("source_path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("_first"))
              .select("source_path", "block", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    return (rows.join(sized_broadcast(splits), ["source_path", "block"])
            .select("source_path", (F.col("_before") + F.col("pos") - F.col("_first")).alias("line"), "cells"))


def by_encoding(files: Sequence[tuple[str, str, bool]]) -> list[tuple[str, bool, list[str]]]:
    """(path, encoding, quotes) rows as groups for ``records``."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for path, encoding, marks in files:
        groups.setdefault((encoding, marks), []).append(path)
    return [(e, m, sorted(p)) for (e, m), p in sorted(groups.items())]

