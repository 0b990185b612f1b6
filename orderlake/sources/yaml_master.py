"""YAML masters (S12) as a Spark data source: one row per top-level key.

A master is a block mapping from a code to its attributes.  Only a line that
starts in the first column begins an entry, so a file can be cut at any byte: a
partition reads the entries whose key line begins in its range, the last of
them to its end.  No task or driver holds a file.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, offset long, key string, attrs map<string,string>"
SPLIT_BYTES = 32 << 20

# fixed values of YAML 1.1: plain scalars that are null, and those that are false or zero
NULLS = {"", "~", "null", "Null", "NULL"}
FALSY = {"0", "0.0", "false", "False", "FALSE", "no", "No", "NO", "off", "Off", "OFF"}
ESCAPES = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b",
           '"': '"', "/": "/", "\\": "\\", " ": " ", "N": "\x85", "_": "\xa0", "L": " ", "P": " "}

_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|(?:[^\s\-?:,\[\]{}#&*!|>'"%@`]|[-?:](?=\S)).*?)[ \t]*:(?:[ \t]+(.*)|)$""")
_QUOTED = {'"': re.compile(r'"((?:[^"\\]|\\.)*)"', re.S), "'": re.compile(r"'((?:[^']|'')*)'")}


class Plain(str):
    """A scalar without quotes: its text is kept as written (``007`` stays ``007``)."""


def _plain(text: str) -> str | None:
    return None if text in NULLS else Plain(text)


def _unquoted(text: str, mark: str) -> str:
    """The value between quotes; a line break is a blank, an empty line a line feed."""
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", text)
    text = re.sub(r"\\\n", "", text) if mark == '"' else text
    text = re.sub(r"\n+", lambda m: " " if len(m[0]) == 1 else m[0][1:], text)
    if mark == "'":
        return text.replace("''", "'")

    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1][1:], 16))
        if m[2] not in ESCAPES:
            raise ValueError(f"unknown escape \\{m[2]}")
        return ESCAPES[m[2]]
    return re.sub(r"\\(?:(x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})|(.))", one, text)


def _folded(lines: list[str]) -> str:
    """Single line breaks as blanks, except beside lines that are indented further."""
    text, gap, last = "", 0, None
    for line in lines:
        if not line:
            gap += 1
            continue
        kept = last is not None and (last[0] in " \t" or line[0] in " \t")
        text += ("" if last is None else "\n" if kept else "" if gap else " ") + "\n" * gap + line
        gap, last = 0, line
    return text


class Entry:
    """The value of one top-level key, from its lines."""

    def __init__(self, lines: list[str]):
        self.lines, self.at = lines, 0

    def parse(self) -> tuple[str | None, object]:
        (key, value), = self._mapping(0).items()
        return key, value

    def _next(self) -> int:
        """Indent of the next line that is neither empty nor a comment; -1 at the end."""
        while self.at < len(self.lines):
            line = self.lines[self.at]
            body = line.lstrip(" ")
            if body.strip() and not body.startswith("#"):
                if body.startswith("\t"):
                    raise ValueError("a tab indents a line")
                return len(line) - len(body)
            self.at += 1
        return -1

    def _is_item(self, indent: int) -> bool:
        return re.match(r"-(\s|$)", self.lines[self.at][indent:]) is not None

    def _mapping(self, indent: int) -> dict:
        out = {}
        while (here := self._next()) >= indent and not (here == indent and self._is_item(indent)):
            m = _KEY.match(self.lines[self.at][indent:].rstrip())
            if here > indent or not m:
                raise ValueError(f"no key: {self.lines[self.at][:80]!r}")
            self.at += 1
            name = m[1]
            name = _unquoted(name[1:-1], name[0]) if name[0] in "\"'" else _plain(name)
            out[name] = self._value(m[2] or "", indent)
        return out

    def _sequence(self, indent: int) -> list:
        out = []
        while self._next() == indent and self._is_item(indent):
            rest = self.lines[self.at][indent + 1:]
            body = rest.lstrip(" ")
            if _KEY.match(body.rstrip()) or re.match(r"-(\s|$)", body):      # a nested block on the item's own line
                inner = indent + 1 + len(rest) - len(body)
                self.lines[self.at] = " " * inner + body
                out.append(self._block(inner))
            else:
                self.at += 1
                out.append(self._value(body, indent))
        return out

    def _block(self, indent: int):
        return self._sequence(indent) if self._is_item(indent) else self._mapping(indent)

    def _value(self, rest: str, indent: int):
        rest = rest.strip()
        if rest.startswith("#"):
            rest = ""
        if not rest:
            inner = self._next()
            if inner > indent or (inner == indent and self._is_item(indent)):
                if inner > indent and not self._is_item(inner) and not _KEY.match(self.lines[self.at][inner:].rstrip()):
                    rest = self.lines[self.at].strip()          # a scalar on the line below its key
                    self.at += 1
                    return self._value(rest, indent)
                return self._block(inner)
            return None
        if rest[0] in "|>":
            return self._literal(rest, indent)
        if rest[0] in "\"'":
            return self._quoted(rest, indent)
        if rest[0] in "[{":
            value, end = self._flow(rest, 0)
            if rest[end:].strip() and not rest[end:].lstrip().startswith("#"):
                raise ValueError(f"text after a flow collection: {rest[:80]!r}")
            return value
        if rest[0] in "&*!%@`":
            raise ValueError(f"anchors, aliases and tags are not read: {rest[:80]!r}")
        parts = [re.sub(r"\s+#.*$", "", rest)]
        while parts[-1] == rest and self._next() > indent:       # a plain scalar goes on in deeper lines
            rest = self.lines[self.at].strip()
            if _KEY.match(rest):
                raise ValueError(f"a mapping inside a scalar: {rest[:80]!r}")
            parts.append(re.sub(r"\s+#.*$", "", rest))
            self.at += 1
        return _plain(" ".join(parts))

    def _quoted(self, rest: str, indent: int) -> str:
        while not (m := _QUOTED[rest[0]].match(rest)):
            if self.at == len(self.lines):
                raise ValueError(f"a quote is not closed: {rest[:80]!r}")
            rest += "\n" + self.lines[self.at].strip()
            self.at += 1
        after = rest[m.end():].strip()
        if after and not after.startswith("#"):
            raise ValueError(f"text after a quote: {after[:80]!r}")
        return _unquoted(m[1], rest[0])

    def _literal(self, head: str, indent: int) -> str:
        """A block scalar: ``|`` keeps line breaks, ``>`` folds single ones."""
        m = re.match(r"([|>])(?:([1-9])?([+-])?|([+-])([1-9]))\s*(#.*)?$", head)
        if not m:
            raise ValueError(f"not a block scalar's head: {head[:80]!r}")
        given, chomp, body = m[2] or m[5], m[3] or m[4] or "", []
        depth = indent + int(given) if given else None
        while self.at < len(self.lines):
            line = self.lines[self.at]
            own = len(line) - len(line.lstrip(" "))
            if line.strip():
                depth = depth or max(own, indent + 1)
                if own < depth:
                    break
            body.append(line[depth or own:] if line.strip() or (depth and own > depth) else "")
            self.at += 1
        tail = len(body)
        while tail and not body[tail - 1].strip(" "):
            tail -= 1
        text, blank = "\n".join(body[:tail]), len(body) - tail
        if m[1] == ">":
            text = _folded(body[:tail])
        return text if chomp == "-" or not tail and not chomp else text + "\n" * (1 + blank if chomp == "+" else 1)

    def _flow(self, s: str, at: int):
        """(value, end) of a one-line ``[a, b]`` or ``{a: b}`` that begins at ``at``."""
        closing, items, pairs = ("]" if s[at] == "[" else "}"), [], {}
        at += 1
        while True:
            while at < len(s) and s[at] in " \t,":
                at += 1
            if at == len(s):
                raise ValueError(f"flow collections over several lines are not read: {s[:80]!r}")
            if s[at] == closing:
                return (items if closing == "]" else pairs), at + 1
            name, at = self._flow_value(s, at)
            if closing == "]":
                items.append(name)
                continue
            m = re.compile(r"\s*:\s*").match(s, at)
            pairs[name] = None
            if m:
                at = m.end()
                if at < len(s) and s[at] not in ",}":
                    pairs[name], at = self._flow_value(s, at)

    def _flow_value(self, s: str, at: int):
        if s[at] in "[{":
            return self._flow(s, at)
        if s[at] in "\"'":
            m = _QUOTED[s[at]].match(s, at)
            if not m:
                raise ValueError(f"a quote is not closed: {s[:80]!r}")
            return _unquoted(m[1], s[at]), m.end()
        m = re.compile(r"(?:[^,\[\]{}:]|:(?=\S))+").match(s, at)
        if not m or m[0][0] in "&*!":
            raise ValueError(f"not a flow collection: {s[:80]!r}")
        return _plain(m[0].strip()), m.end()


def flat(value, name: str = "") -> dict[str, str | None]:
    """Attributes by dotted name: ``size.width``, ``tags.0``; a bare scalar is ``value``."""
    if isinstance(value, (dict, list)):
        out = {}
        for k, v in (value.items() if isinstance(value, dict) else enumerate(value)):
            out |= flat(v, f"{name}.{k if k is not None else ''}" if name else str(k if k is not None else ""))
        return out
    return {name or "value": None if value is None else str(value)}


def falsy(value) -> bool:
    """What a truth test of the loaded value would drop: null, empty, zero, false."""
    return not value or (isinstance(value, Plain) and str(value) in FALSY)


def _starts(line: bytes) -> bool:
    """Whether a line begins a top-level entry (not a comment, a list item or a document mark)."""
    return bool(line.strip()) and line[:1] not in b" \t#%\r\n" and re.match(rb"(-|---|\.\.\.)(\s|$)", line) is None


def entries(f, start: int, end: int) -> Iterator[tuple[int, list[str]]]:
    """(byte offset, lines) of the entries whose key line begins in [start, end)."""
    f.seek(max(0, start - 1))
    if start:
        f.readline()                    # the rest of the line that the range before owns
    at, held, offset = f.tell(), [], 0
    while held or at < end:
        line = f.readline()
        if not line:
            break
        text = line[3:] if at == 0 and line.startswith(b"\xef\xbb\xbf") else line
        if _starts(text):
            if held:
                yield offset, held
            held = []
            if at >= end:
                break
            held, offset = [text.decode("utf-8").rstrip("\r\n")], at
        elif held and re.match(rb"(---|\.\.\.)(\s|$)", text) is None:
            held.append(text.decode("utf-8").rstrip("\r\n"))
        elif not held and at == 0 and text[:1] == b"-" and text[:3] != b"---":
            raise ValueError("a master is a mapping of codes, not a list")
        at += len(line)
    if held:
        yield offset, held


@dataclass
class FileRange(InputPartition):
    file: str
    start: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[FileRange]:
        from pyarrow import fs

        from .digests import opened
        store, name = opened(self.path)
        info = store.get_file_info(name)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        infos = [info] if info.is_file else [
            x for x in store.get_file_info(fs.FileSelector(name, recursive=True))
            if x.is_file and not x.base_name.startswith(("_", "."))]
        scheme = re.match(r"[a-z0-9]+://[^/]*|file:|", self.path)[0]
        return [FileRange(f"{scheme}{x.path}" if scheme.startswith("file") or not scheme else f"{scheme}/{x.path.lstrip('/')}",
                          at, min(at + self.split, x.size))
                for x in sorted(infos, key=lambda x: x.path) for at in range(0, x.size, self.split)] or [FileRange("", 0, 0)]

    def read(self, part: FileRange) -> Iterator[tuple]:
        from .digests import opened
        if not part.file:
            return
        store, name = opened(part.file)
        with store.open_input_file(name) as raw, io.BufferedReader(raw, 1 << 20) as f:
            for offset, lines in entries(f, part.start, part.end):
                try:
                    key, value = Entry(lines).parse()
                except ValueError as e:
                    raise ValueError(f"{part.file}, entry at byte {offset}: {e}") from e
                yield (part.file, offset, None if falsy(key) else str(key), None if falsy(value) else flat(value))


class YamlMaster(DataSource):
    """``spark.read.format("yaml_master").load(path)``; option ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "yaml_master"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)
