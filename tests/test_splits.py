"""Text files read in splits of a few bytes against reading them whole."""

import csv
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.sources import files, splits


@pytest.fixture()
def tiny(spark):
    """Sets the split size for a read."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(k) for k in keys]

    def put(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")
    yield put
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _expected(text):
    """Python's csv reader; nothing and quoted nothing are alike to it."""
    out = []
    for row in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")):
        if row:
            out.append([c.replace("\r\n", "\n").replace("\r", "\n") for c in row])
    return out


def _read(spark, path, encoding, quoted=True, sep=","):
    marks = [(encoding, True, [path])]
    rows = splits.records(spark, marks, sep, quoted).orderBy("line").collect()
    assert [r.line for r in rows] == list(range(len(rows)))
    return [[c or "" for c in r.cells] for r in rows]


ALPHABET = ["a", "上", "ਊ一", "Ā਀", '"', '""', ",", "\n", "\r\n", '"x,\ny"', ',"', '",', "長い", "5\" disk"]


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16LE", "UTF-16BE", "x-windows-950"])
@pytest.mark.parametrize("size", [23, 64])
def test_random_text_in_splits(spark, tmp_dir, tiny, encoding, size):
    rng = random.Random(size)
    python = {"x-windows-950": "cp950"}.get(encoding, encoding)
    letters = [a for a in ALPHABET if python != "cp950" or a in ("上",) or a.isascii()]
    tiny(size)
    # the text source doesn't tell whether a last line feed is there, which only an open quote would keep
    text = "head,er\n" + "".join(rng.choice(letters) for _ in range(70)) + "end"
    _write(f"{tmp_dir}/{size}.csv", text.encode(python))
    assert _read(spark, f"{tmp_dir}/{size}.csv", encoding) == _expected(text), text


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet='a",\n\r', max_size=14), st.integers(0, 14))
def test_cells_like_a_csv_reader(text, cut):
    cells = splits.Cells(",")
    got = [[c or "" for c in r] for r in cells.records(text)]
    assert got == _expected(text)
    at = text.find("\n", cut)                                   # the state at a line feed is that of the whole
    if at >= 0 and not cells.after_all(text[:at]):
        rest = [[c or "" for c in r] for part in (text[:at], text[at + 1:]) for r in cells.records(part)]
        assert rest == got


def test_multi_line_file_in_many_tasks(spark, tmp_dir, tiny):
    rows = [[str(k), f'note "{k}"\nline, two' * (k % 4), "上午" * (k % 9)] for k in range(3000)]
    buf = io.StringIO()
    csv.writer(buf).writerows([["id", "a\nb", "c"], *rows])
    for enc, name in (("utf-8", "u.csv"), ("utf-16", "w.csv")):
        _write(f"{tmp_dir}/m/{name}", buf.getvalue().encode(enc))
    tiny(5000)
    got, report = files.read_reports(spark, f"{tmp_dir}/m")
    assert got.columns[:3] == ["id", "a\nb", "c"]
    for name in ("u.csv", "w.csv"):
        mine = [r for r in got.collect() if r.source_file == name]
        mine.sort(key=lambda r: r.source_line)
        assert [[r[0], r[1] or "", r[2] or ""] for r in mine] == rows
    assert {r["name"]: (r.records, r.bad_records) for r in report.collect()} == {"u.csv": (3000, 0), "w.csv": (3000, 0)}
    pieces = splits.pieces(spark, [f"{tmp_dir}/m/u.csv"], "UTF-8")
    assert pieces.select("block").distinct().count() > 20


def test_a_cell_longer_than_many_splits(spark, tmp_dir, tiny):
    text = 'a,b\n1,"' + "line\n" * 100 + '"\n2,x\n"open\n' + "y\n" * 20 + "end"
    _write(f"{tmp_dir}/l/l.csv", text.encode())
    tiny(40)
    assert _read(spark, f"{tmp_dir}/l/l.csv", "UTF-8") == _expected(text)


def test_surplus_cells_and_names(spark, tmp_dir):
    _write(f"{tmp_dir}/n/a.csv", 'ID,id,source_file,we`ird,\n1,2,3,4\n5,6,7,8,"9,9"\n1,2,3,4,,\n'.encode())
    _write(f"{tmp_dir}/n/b.csv", "id,價\n7,8\n".encode("cp950"))
    _write(f"{tmp_dir}/n/c+d 100%[x]{{y}}.csv", b"id\n9\n")
    rows, report = files.read_reports(spark, f"{tmp_dir}/n")
    assert rows.columns == ["ID", "id.1", "source_file.1", "we`ird", "價", *files.PROVENANCE, files.CORRUPT]
    got = sorted(tuple(r) for r in rows.select("ID", "`id.1`", "`source_file.1`", "價", "source_file", files.CORRUPT).collect())
    assert got == [("1", "2", "3", None, "a.csv", None), ("1", "2", "3", None, "a.csv", None),
                   ("5", "6", "7", None, "a.csv", '5,6,7,8,"9,9"'), ("7", None, None, "8", "b.csv", None),
                   ("9", None, None, None, "c+d 100%[x]{y}.csv", None)]
    good, bad = files.quarantine(rows)
    assert good.count() == 4 and bad.count() == 1
    assert {r["name"]: r.bad_records for r in report.collect()} == {"a.csv": 1, "b.csv": 0, "c+d 100%[x]{y}.csv": 0}


def test_folders_without_rows(spark, tmp_dir):
    _write(f"{tmp_dir}/e/empty.csv", b"")
    rows, report = files.read_reports(spark, f"{tmp_dir}/e")
    assert rows.count() == 0 and rows.columns == [*files.PROVENANCE, files.CORRUPT]
    assert report.count() == 0                                  # Spark lists no empty files
    _write(f"{tmp_dir}/e/head.csv", b"a,b\n\n")
    rows, _ = files.read_reports(spark, f"{tmp_dir}/e")
    assert rows.count() == 0 and rows.columns[:2] == ["a", "b"]


def test_encodings_of_files_cut_inside_characters(spark, tmp_dir, tiny):
    text = "訂單,上\n" * 300 + "尾"
    cases = {"utf8": ("utf-8", 0, "UTF-8"), "utf8cut": ("utf-8", 1, None), "cp950": ("cp950", 0, "x-windows-950"),
             "cp950cut": ("cp950", 1, None), "utf16": ("utf-16", 0, "UTF-16"), "ascii": ("ascii", 0, "UTF-8")}
    for name, (enc, cut, _) in cases.items():
        data = ("plain,text\n" * 50 if enc == "ascii" else text).encode(enc)
        _write(f"{tmp_dir}/x/{name}.csv", data[:len(data) - cut])
    for size in (100, 10_000_000):
        tiny(size)
        got = {r["path"].rsplit("/", 1)[-1]: r["encoding"] for r in files.detect_encoding(
            spark, f"{tmp_dir}/x", ["UTF-8", "x-windows-950"]).collect()}
        assert got == {f"{name}.csv": want for name, (_, _, want) in cases.items()}


def test_tsv_in_splits_and_utf8_fallback(spark, tmp_dir, tiny):
    lines = [f'O{k}\t上"{k}\t=\"0{k}\"' for k in range(2000)]
    text = "【※此匯出資料】\n訂單\t名\t電話\n" + "\r\n".join(lines) + "\n\t\n"
    _write(f"{tmp_dir}/t/w.tsv", text.encode("utf-16"))
    _write(f"{tmp_dir}/t/u.tsv", text.encode("utf-8-sig"))
    tiny(9000)
    rows = files.read_banner_tsv(spark, f"{tmp_dir}/t", banner="【※此匯出資料")
    for name in ("w.tsv", "u.tsv"):
        mine = sorted((r for r in rows.collect() if r.source_file == name), key=lambda r: r.line_no)
        assert ["\t".join(r["values"]) for r in mine][:2000] == lines and mine[0].line_no == 2
        assert mine[0].header == ["訂單", "名", "電話"]


def test_states_that_meet_are_followed_once(monkeypatch):
    import pyarrow as pa
    ended, end = [], splits.Scan._end_line
    monkeypatch.setattr(splits.Scan, "_end_line", lambda s: ended.append(1) or end(s))
    for encoding, states in (("UTF-8", 2), ("UTF-16LE", 4)):
        ended.clear()
        lines = [f'{k},"a ""{k}"" b, c",d' for k in range(1000)]
        pieces = [x.encode(splits.codec(encoding)) for x in lines]
        batch = pa.RecordBatch.from_arrays([pa.array(["p"] * 1000), pa.array([0] * 1000), pa.array(pieces)],
                                           ["source_path", "block", "piece"])
        out = [r for b in splits._summary(splits.Cells(","), encoding)(iter([batch])) for r in b.to_pylist()]
        assert len(out) == 1 and len(out[0]["ends"]) == states and out[0]["ends"][0] == 0
        assert len(ended) < 1100
