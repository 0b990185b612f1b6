"""YAML masters: the parser against plain values, byte ranges against the one-range read."""

import io

import pytest

from orderlake.sources import master, yaml_master
from orderlake.sources.yaml_master import Entry, entries, falsy, flat

TEXT = """\ufeff# masters
---
4711:   # comment
  name: plain # c
  q: 'it''s: here'
  d: "a\\u4e0a\\n b"
  tags: [x, "y, z", {k: v}]
  size:
    w: 007
    h: ~
  items:
  - one
  - a: 1
    b: 2
  text: |
    line 1

      line 2
  fold: >-
    a
    b

    c
  long: first
    second
  multi: "x
    y"
  name: again
"0815":
- a
- b
~: {name: gone}
0:
  name: gone
'': {name: gone}
x:y: {a: 1}
上架: 金額
empty:
none: {}
4711x: {name: 'last line has no end'}"""

WANT = {"4711": {"name": "again", "q": "it's: here", "d": "a上\n b", "tags.0": "x", "tags.1": "y, z", "tags.2.k": "v",
                 "size.w": "007", "size.h": None, "items.0": "one", "items.1.a": "1", "items.1.b": "2",
                 "text": "line 1\n\n  line 2\n", "fold": "a b\nc", "long": "first second", "multi": "x y"},
        "0815": {"0": "a", "1": "b"}, "x:y": {"a": "1"}, "上架": {"value": "金額"}, "4711x": {"name": "last line has no end"}}


def _kept(parts):
    return {str(k): flat(v) for k, v in (Entry(lines).parse() for _, lines in parts) if not falsy(k) and not falsy(v)}


@pytest.mark.parametrize("step", [1, 2, 7, 64, 10_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_cut_anywhere(step, end):
    data = TEXT.replace("\n", end).encode()
    parts = [e for at in range(0, len(data), step) for e in entries(io.BytesIO(data), at, min(at + step, len(data)))]
    assert len(parts) == 10 and _kept(parts) == WANT


@pytest.mark.parametrize("text", [
    "", "a: 1", "a: {}", "a:\n  b: |+\n    x\n\n", "a:\n  b: >\n    x\n      y\n    z\n", "a:\n  - - 1\n    - 2\n  - 3\n",
    "a:\n  b: 'x\n\n    y'\n", 'a:\n  b: "x \\\n    y"\n', "a:\n  \"k: 1\": v\n  'k''s': w\n", "a:\n  b: x:y # no\n  c: d#e\n",
    "a:\n  b:\n    plain below\n", "a:\n  b: |2\n      two more\n    x\n", "a: [ ]\n", "a: {x: [1, {y: 2}], z: 1}\n"])
def test_agrees_with_a_yaml_library(text):
    yaml = pytest.importorskip("yaml")
    want = {str(k): flat(v) for k, v in (yaml.load(text, yaml.BaseLoader) or {}).items() if v}
    assert _kept(entries(io.BytesIO(text.encode()), 0, len(text.encode()))) == want


@pytest.mark.parametrize("text", ["a: &x 1", "a: *x", "a: !t 1", "a: [1,\n  2]", "a:\n\tb: 1", "a:\n  b: 'open", "a:\n  word\n  b: 1",
                                  "a:\n  b: \"x\" y", "a:\n   b: 1\n  c: 2", "no colon"])
def test_what_is_not_read_is_refused(text):
    with pytest.raises(ValueError):
        _kept(entries(io.BytesIO(text.encode()), 0, len(text)))


def test_load(spark, tmp_dir):
    for n, text in enumerate([TEXT, "4711: {name: later file}\n", ""]):
        with open(f"{tmp_dir}/m{n}.yaml", "wb") as f:
            f.write(text.encode())
    got = {r.code: r.attrs for r in master.load_yaml_dimension(spark, tmp_dir, "code", split_bytes=40).collect()}
    assert got == WANT | {"4711": {"name": "later file"}}
    cols = master.load_yaml_dimension(spark, f"{tmp_dir}/m0.yaml", "code", ["name", "size.w"]).filter("code LIKE '4711%'")
    assert sorted(map(tuple, cols.collect())) == [("4711", "again", "007"), ("4711x", "last line has no end", "")]
    assert master.load_yaml_dimension(spark, f"{tmp_dir}/m2.yaml").collect() == []
    assert yaml_master.SCHEMA.startswith("file")


def test_a_bad_entry_names_its_file(spark, tmp_dir):
    with open(f"{tmp_dir}/bad.yaml", "w") as f:
        f.write("ok: {a: 1}\nbad: *x\n")
    with pytest.raises(Exception, match="bad.yaml, entry at byte 11"):
        master.load_yaml_dimension(spark, tmp_dir).collect()
