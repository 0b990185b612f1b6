"""Report-file scans with provenance.

Raw reports are read as all-string tables (no inference, so leading zeros
survive), in splits (see ``splits``) and grouped per encoding; every file keeps
its own header, and files are united by name.  Provenance comes from
``_metadata``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.functions.text import NULL_TOKENS
from orderlake.operators._common import sized_broadcast
from orderlake.session import ensure_checkpoint_dir

from . import splits

# The order in which text encodings are tried for a report.
ENCODINGS = ["UTF-8", "x-windows-950", "Big5", "GBK", "GB2312"]


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               exclude_dirs: Sequence[str] = ("backup", "archive"), recursive: bool = True) -> DataFrame:
    """(path, name, length, modificationTime) of files under ``path``;
    folders named in ``exclude_dirs`` are skipped.  Content is not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    for d in exclude_dirs:
        df = df.filter(~F.lower(F.col("path")).contains(f"/{d.lower()}/"))
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1))


def _path_of(metadata_path: Column) -> Column:
    """``_metadata.file_path`` in the form that listings have."""
    plain = F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def _inspected(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str] = ENCODINGS) -> list:
    """(source_path, source_file, source_mtime, encoding, kind, quotes) per
    non-empty file; ``encoding`` is None where none decodes it, and ``kind`` tells
    the two UTF-16 byte orders apart.  One aggregate over the lines of all files,
    another over those of files that are neither UTF-16 nor UTF-8."""
    if not paths:
        return []
    found = [r.asDict() for r in splits.inspect(spark, paths).orderBy("source_path").collect()]     # one row per file
    legacy = [e for e in encodings if e.upper() not in ("UTF-8", "UTF8")]
    rest = [f["source_path"] for f in found if f["mark"] not in splits.MARKS
            and not (f["utf8"] and len(legacy) < len(encodings))]
    other = {r["source_path"]: r["encoding"] for r in splits.readable_as(
        spark, [splits.literal(p) for p in rest], legacy).collect()} if rest and legacy else {}
    for f in found:
        f["source_file"] = unquote(f["source_file"])
        f["kind"] = splits.MARKS.get(f["mark"]) or other.get(f["source_path"], None if f["source_path"] in rest else "UTF-8")
        f["encoding"] = "UTF-16" if f["mark"] in splits.MARKS else f["kind"]
    return found


def _listed(spark: SparkSession, found: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame([(f["source_path"], f["source_file"], f["source_mtime"], f["encoding"]) for f in found],
                                 "source_path string, source_file string, source_mtime timestamp, source_encoding string")


def detect_encoding(spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """(path, encoding) per file: the first encoding that decodes the *whole* file cleanly.

    UTF-16 byte-order marks are recognised first, then UTF-8, then the legacy
    charsets.  The encoding of a file that none decodes is NULL;
    empty files are not listed.  Files are read in splits, line by line: in every
    encoding without a mark a line feed ends a character, so a file is valid when
    its lines are, and their answers are combined by one aggregate.  No task
    holds a file."""
    paths = [splits.escaped(r["path"]) for r in list_files(spark, path, exclude_dirs=()).select("path").collect()]
    return _listed(spark, _inspected(spark, paths, encodings)).select(
        _path_of(F.col("source_path")).alias("path"), F.col("source_encoding").alias("encoding"))


CORRUPT = "_corrupt_record"
PROVENANCE = ["source_file", "source_path", "source_mtime", "source_encoding", "source_line"]


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_names(header: Sequence[str | None]) -> list[str]:
    """Header cells as column names: blank cells by position (``Unnamed: 2``);
    a name that came before in any case, or that the provenance columns have,
    is numbered (``a``, ``a.1``).  Empty cells at the end have no column."""
    cells = [c and c.removeprefix("\ufeff") for c in header]          # a mark inside the quotes of the first
    while cells and not cells[-1]:
        cells.pop()
    used, out = {c.lower() for c in [*PROVENANCE, CORRUPT]}, []
    for k, c in enumerate(cells):
        base = name = c or f"Unnamed: {k}"
        n = 0
        while name.lower() in used:
            n += 1
            name = f"{base}.{n}"
        used.add(name.lower())
        out.append(name)
    return out


def _named(batches):
    for b in batches:
        b["names"] = [column_names(h) for h in b["cells"]]
        yield b[["source_path", "names"]]


def _as_csv(sep: str) -> Column:
    """A record's cells as one line of text."""
    plain = F.transform("cells", lambda c: F.when(
        F.contains(c, F.lit(sep)) | F.contains(c, F.lit('"')) | F.contains(c, F.lit("\n")),
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))))
    return F.array_join(plain, sep)


def _records(spark: SparkSession, found: Sequence[dict], sep: str, quoted: bool = True) -> DataFrame:
    groups = splits.by_encoding([(splits.literal(f["source_path"]), f["kind"], f["quotes"]) for f in found])
    out = splits.records(spark, groups, sep, quoted)
    return out if out is not None else spark.createDataFrame([], "source_path string, line long, cells array<string>")


def _own_headers(spark: SparkSession, found: Sequence[dict], sep: str) -> DataFrame:
    """All-string rows of files that each have a header of their own, united by
    name (in any case).

    The records are read in splits and written once, as arrays.  The first record
    of a file names its columns; the names (one row per file) are joined back,
    and each column picks its cell by the file's own position.
    """
    ensure_checkpoint_dir(spark)
    rows = _records(spark, found, sep)
    heads = (rows.filter("line = 0").select("source_path", "cells")
             .mapInPandas(_named, "source_path string, names array<string>").checkpoint(eager=True))
    names = [r["n"] for r in heads.select("source_path", F.posexplode("names").alias("p", "n")).groupBy(F.lower("n")).agg(
        F.min(F.struct("source_path", "p", "n")).alias("at")).select("at", "at.n").orderBy("at").collect()]   # distinct names
    index = heads.select("source_path", F.size("names").alias("_width"), F.transform(
        F.array(*[F.lit(n.lower()) for n in names]).cast("array<string>"), lambda n: F.array_position(
            F.transform("names", F.lower), n).cast("int")).alias("_index"))
    rows = (rows.filter("line > 0").join(sized_broadcast(index), "source_path")
            .join(sized_broadcast(_listed(spark, found)), "source_path"))
    rows = rows.select("source_file", "source_path", "source_mtime", "source_encoding",
                       F.col("line").alias("source_line"), "cells", "_width", "_index")
    cell = lambda k: F.when(F.col("_index")[k] > 0, F.get("cells", F.col("_index")[k] - 1))        # noqa: E731
    surplus = F.exists(F.slice("cells", F.col("_width") + 1, F.greatest(F.size("cells") - F.col("_width"), F.lit(0))),
                       lambda c: F.coalesce(c, F.lit("")) != "")
    return rows.select(*[cell(k).alias(n) for k, n in enumerate(names)], *PROVENANCE,
                       F.when(surplus, _as_csv(sep)).alias(CORRUPT))


def read_orders(spark: SparkSession, paths_by_encoding: Mapping[str, Sequence[str]],
                sep: str = ",", null_tokens: Sequence[str] | None = None,
                keep_blank: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """All-string rows of the reports, united by the header of each
    file (missing columns NULL), with file provenance, ``source_line`` (the
    record's place in its file) and ``_corrupt_record``.

    Files are read in splits, whether or not quoted cells hold line breaks, and
    in every encoding.  A record with filled cells beyond its file's header is
    kept and has its text in ``_corrupt_record``.  With ``columns`` (the report's
    header names, in file order) the first record of a file is skipped, and a
    record of any other number of cells is marked so — see ``quarantine``.
    ``keep_blank`` keeps quoted empty cells as ''; others are NULL.  No files or
    only empty ones give no rows."""
    found = []
    for enc, paths in paths_by_encoding.items():
        for f in _inspected(spark, list(paths), ["UTF-8"]):
            found.append({**f, "encoding": enc, "kind": splits.MARKS.get(f["mark"], enc) if enc.upper().startswith("UTF-16")
                          else enc})
    return _read(spark, found, sep, null_tokens, keep_blank, columns)


def _read(spark: SparkSession, found: Sequence[dict], sep: str = ",", null_tokens: Sequence[str] | None = None,
          keep_blank: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")
    if columns is None:
        out = _own_headers(spark, found, sep)
    else:
        rows = _records(spark, found, sep).filter("line > 0").join(sized_broadcast(_listed(spark, found)), "source_path")
        out = rows.withColumn("source_line", F.col("line")).select(
            *[F.get("cells", F.lit(k)).alias(c) for k, c in enumerate(columns)],
            F.when(F.size("cells") != len(columns), _as_csv(sep)).alias(CORRUPT), *PROVENANCE)
    toks = [] if null_tokens is False else list(NULL_TOKENS if null_tokens is None else null_tokens)
    toks += [] if keep_blank else [""]
    own = {*PROVENANCE, CORRUPT}
    value = lambda c: F.col(quoted_name(c))                                                        # noqa: E731
    return out.select(*[F.when(~F.coalesce(value(c).isin(*toks), F.lit(False)), value(c)).alias(c)
                        if toks and c not in own else value(c) for c in out.columns])


def read_reports(spark: SparkSession, path: str, glob: str | None = None,
                 encodings: Sequence[str] = ENCODINGS, **options) -> tuple[DataFrame, DataFrame]:
    """S1 + S5 + S6: (rows of all readable reports below ``path``, scan report).
    The scan report has one row per file: path, name, encoding, readable,
    records, bad_records (those with text in ``_corrupt_record``); a file that no
    encoding decodes is left out of the rows and reported."""
    listing = list_files(spark, path, glob=glob).checkpoint(eager=True)
    paths = [splits.escaped(r["path"]) for r in listing.select("path").collect()]      # one row per file
    found = _inspected(spark, paths, encodings)
    rows = _read(spark, [f for f in found if f["kind"]], **options)
    counts = rows.groupBy("source_path").agg(F.count(F.lit(1)).alias("records"),
                                             F.count(CORRUPT).alias("bad_records"))
    known = _listed(spark, found).join(sized_broadcast(counts), "source_path", "left").select(
        _path_of(F.col("source_path")).alias("path"), "source_encoding", "records", "bad_records")
    report = listing.join(sized_broadcast(known), "path", "left").select(
        "path", "name", F.col("source_encoding").alias("encoding"), F.col("source_encoding").isNotNull().alias("readable"),
        F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("bad_records", F.lit(0)).alias("bad_records"))
    return rows, report.checkpoint(eager=True)


def header_lines(spark: SparkSession, path: str, sep: str = ",", encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """(path, file, encoding, header array) of every readable file below
    ``path``: the cells of its first line, by one aggregate over its lines."""
    files = list_files(spark, path, exclude_dirs=()).select("path").collect()       # one row per file
    found = [f for f in _inspected(spark, [splits.escaped(r["path"]) for r in files], encodings) if f["kind"]]
    out = spark.createDataFrame([], "source_path string, header array<string>")
    for kind, _, paths in splits.by_encoding([(splits.literal(f["source_path"]), f["kind"], False) for f in found]):
        lines = splits.pieces(spark, paths, kind).withColumn("_at", F.struct("block", F.monotonically_increasing_id()))
        first = lines.groupBy("source_path").agg(F.min_by("piece", "_at").alias("piece"))
        text = F.regexp_replace(F.decode("piece", kind), "\r|^\ufeff", "")
        out = out.unionByName(first.select("source_path", F.split(text, re.escape(sep), -1).alias("header")))
    return out.join(sized_broadcast(_listed(spark, found)), "source_path").select(
        _path_of(F.col("source_path")).alias("path"), F.col("source_file").alias("file"),
        F.col("source_encoding").alias("encoding"), "header")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a ``read_orders(columns=…)`` result into (good rows, bad rows);
    bad rows keep their raw line and file provenance for the report."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull())
    return good, bad


def read_banner_tsv(spark: SparkSession, path: str, banner: str | None = None,
                    encoding: str = "UTF-16", header_line: int = 2,
                    require_headers: Sequence[str] = ()) -> DataFrame:
    """Tab-separated exports whose header sits on ``header_line``
    (1-based).  With ``banner`` the first line must start with it, else the
    file is skipped.  ``require_headers`` keeps only files whose header
    contains every listed keyword (substring).  A file with a UTF-16 mark is
    read as that; another one as ``encoding``, or as UTF-8 where that is UTF-16.
    Files are read in splits and written once as cells; a file's banner and
    header are one row, joined back.  Returns long form (source_path,
    source_file, line_no, header array, values array) so files with different
    headers stay separate; ``pivot_banner_rows`` turns it into columns."""
    other = "UTF-8" if encoding.upper().startswith("UTF-16") else encoding
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")
    found = [{**f, "kind": splits.MARKS.get(f["mark"], other)} for f in _inspected(spark, [path], ["UTF-8"])]
    rows = _records(spark, found, "\t", quoted=False)
    text = F.array_join("cells", "\t")
    heads = rows.filter(F.col("line") < header_line).groupBy("source_path").agg(
        F.max(F.when(F.col("line") == 0, text)).alias("_first"),
        F.max(F.when(F.col("line") == header_line - 1, F.col("cells"))).alias("header")).filter("header IS NOT NULL")
    if banner:
        heads = heads.filter(F.col("_first").startswith(banner))
    for kw in require_headers:
        heads = heads.filter(F.exists("header", lambda h: h.contains(kw)))
    names = heads.join(sized_broadcast(_listed(spark, found)), "source_path").select("source_path", "source_file", "header")
    return (rows.filter((F.col("line") >= header_line) & (F.trim(text) != "")).join(sized_broadcast(names), "source_path")
            .select("source_path", "source_file", F.col("line").cast("int").alias("line_no"), "header",
                    F.col("cells").alias("values")))


def pivot_banner_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project long-form banner rows to the given header names (by header position)."""
    sel = []
    for c in columns:
        idx = F.array_position(F.col("header"), c)
        sel.append(F.when(idx > 0, F.element_at("values", idx.cast("int"))).alias(c))
    return rows.select("source_path", "source_file", "line_no", *sel)


def latest_snapshot(files: DataFrame, stem: Column, by: str = "mtime") -> DataFrame:
    """Newest file per dataset stem, by modification time or by name."""
    order = F.col("modificationTime") if by == "mtime" else F.col("name")
    return files.withColumn("stem", stem).withColumn("__rn", F.row_number().over(
        Window.partitionBy("stem").orderBy(order.desc(), F.col("path").desc()))).filter("__rn = 1").drop("__rn")


# File-name patterns of marketplace exports.
NAME_PATTERNS = {
    "report_code": r"^([A-Z][0-9]{4})",
    "delivery_code": r"^[A-Z][0-9]{4}_([0-9])_",
    "customer_code": r"_([0-9]{6})_",
    "date8": r"_([0-9]{8})_?[0-9]{6}",
    "time6": r"_[0-9]{8}_?([0-9]{6})",
    "copy_no": r"[(（]([0-9]+)[)）]",
}


def file_metadata(files: DataFrame, name: str = "name",
                  patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Regex fields of the file name ('' becomes NULL) and a canonical stem
    (name without copy suffix and extension)."""
    pats = NAME_PATTERNS if patterns is None else patterns
    out = files
    for col, pat in pats.items():
        v = F.regexp_extract(F.col(name), pat, 1)
        out = out.withColumn(col, F.when(v != "", v))
    base = F.regexp_replace(F.col(name), r"\.[A-Za-z0-9]+$", "")
    stem = F.trim(F.regexp_replace(base, r" ?[(（][0-9]+[)）]$", ""))
    return out.withColumn("stem", stem)


def duplicate_files(files: DataFrame, size: str = "length", content: str = "content",
                    order: str = "path") -> DataFrame:
    """Files with identical bytes.  Cheap test first: only files sharing a
    size are hashed (semi join on repeated sizes); then group by (size,
    SHA-256).  Groups are aggregates (count, first member), joined back to
    their members — no window holds a whole group, however many copies it has.
    Returns every member of a duplicate group with ``keep`` on the first."""
    sizes = files.groupBy(size).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(size)
    cand = files.join(sizes, size, "left_semi").withColumn("digest", F.sha2(F.col(content), 256)).drop(content)
    groups = (cand.groupBy(size, "digest")
              .agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("__first"))
              .filter("group_size > 1"))
    return (cand.join(groups, [size, "digest"])
            .withColumn("keep", F.col(order) == F.col("__first")).drop("__first"))


def newest_version(files: DataFrame, canonical: Column) -> DataFrame:
    """Among files with the same canonical name, the newest mtime wins."""
    w = Window.partitionBy("__canon").orderBy(F.col("modificationTime").desc(), F.col("path").desc())
    return (files.withColumn("__canon", canonical).withColumn("__rn", F.row_number().over(w))
            .filter("__rn = 1").drop("__rn").withColumnRenamed("__canon", "canonical_name"))
