"""Field registry and schema conformance.

The registry is small configuration (one entry per canonical field); it is
turned into one ``select`` list, so conformance is a single projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.dates import parse_date_multi, parse_timestamp_multi
from orderlake.functions._util import is_blank, strip
from orderlake.functions.numbers import bool_true_tokens, money2, to_bigint, to_number
from orderlake.functions.text import null_tokens


@dataclass(frozen=True)
class Field:
    name: str
    order: int
    local_name: str = ""
    type: str = "STRING"
    required: bool = False
    default: object = None


# Registry type names and their Spark types.
SPARK_TYPES = {
    "STRING": T.StringType(), "INTEGER": T.LongType(), "INT64": T.LongType(),
    "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(), "NUMERIC": T.DecimalType(18, 2),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(), "TIMESTAMP": T.TimestampNTZType(), "TIME": T.StringType(),
}
_TYPE_DEFAULTS = {"STRING": "", "INTEGER": 0, "INT64": 0, "FLOAT": 0.0, "FLOAT64": 0.0,
                  "NUMERIC": 0, "BOOLEAN": False, "BOOL": False}


def registry_from_rows(rows: Sequence[Mapping]) -> list[Field]:
    """Registry sheet rows -> fields.  A sheet without the column ``name`` is
    refused.  All-blank rows and rows without a name are skipped; a later
    duplicate name replaces the earlier one."""
    if rows and not any("name" in r for r in rows):
        raise ValueError("the registry sheet has no column name")
    out: dict[str, Field] = {}
    for r in rows:
        vals = [str(v).strip() for v in r.values() if v is not None]
        if not any(vals):
            continue
        name = str(r.get("name") or "").strip()
        if not name:
            continue
        out[name] = Field(name=name, order=int(r.get("order") or len(out) + 1),
                          local_name=str(r.get("local_name") or "").strip(),
                          type=str(r.get("type") or "STRING").strip().upper(),
                          required=str(r.get("required") or "").strip().lower() in ("1", "true", "yes", "y", "是"),
                          default=r.get("default"))
    return sorted(out.values(), key=lambda f: (f.order, f.name))


def schema_for(registry: Sequence[Field]) -> T.StructType:
    """K5: registry -> StructType (unknown type names are STRING)."""
    return T.StructType([T.StructField(f.name, SPARK_TYPES.get(f.type, T.StringType()), True)
                         for f in registry])


def type_for_name(name: str, rules: Sequence[tuple[str, str]], default: str = "STRING") -> str:
    """K5 (name-driven): first regex rule matching the column name wins."""
    for pat, typ in rules:
        if re.search(pat, name):
            return typ
    return default


def validate_headers(columns: Sequence[str], registry: Sequence[Field]) -> dict:
    """Missing required and extra columns; ok iff nothing required is missing."""
    names = {f.name for f in registry}
    missing = [f.name for f in registry if f.required and f.name not in columns]
    extra = [c for c in columns if c not in names]
    return {"ok": not missing, "missing": missing, "extra": extra}


def validate_files(headers: DataFrame, registry: Sequence[Field], header: str = "header") -> DataFrame:
    """K10 for many files: ``headers`` (a file's column names in an array) with
    ok, missing (required names, in registry order) and extra (others, in file order)."""
    names = lambda fields: F.array(*[F.lit(f.name) for f in fields]).cast("array<string>")             # noqa: E731
    missing = F.array_except(names([f for f in registry if f.required]), F.col(header))
    return headers.select("*", (F.size(missing) == 0).alias("ok"), missing.alias("missing"),
                          F.array_except(F.col(header), names(registry)).alias("extra"))


def rename(df: DataFrame, mapping: Mapping[str, str], unmapped: str = "keep") -> DataFrame:
    """Local -> canonical names; unmapped columns kept or dropped."""
    sel = []
    for c in df.columns:
        if c in mapping:
            sel.append(F.col(f"`{c}`").alias(mapping[c]))
        elif unmapped == "keep":
            sel.append(F.col(f"`{c}`"))
    return df.select(*sel)


def registry_rename(df: DataFrame, registry: Sequence[Field], unmapped: str = "keep") -> DataFrame:
    """Rename by the registry's local names."""
    return rename(df, {f.local_name: f.name for f in registry if f.local_name}, unmapped)


def normalize_text(c: Column) -> Column:
    """Raw cell -> trimmed text with null tokens as NULL (the cast input)."""
    return strip(null_tokens(c.cast("string")))


def cast_field(c: Column, typ: str, on_error: str = "default", default=None,
               normalized: bool = False) -> Column:
    """Coerce text to a registry type; failures become the type default
    (``on_error='default'``) or NULL (``'null'``).  ``normalized`` says the
    input already went through ``normalize_text``."""
    typ = typ.upper()
    s = c if normalized else normalize_text(c)
    if typ in ("INTEGER", "INT64"):
        v = to_bigint(s)
    elif typ in ("FLOAT", "FLOAT64"):
        v = to_number(s)
    elif typ == "NUMERIC":
        v = money2(s)
    elif typ in ("BOOLEAN", "BOOL"):
        v = F.when(s.isNull(), F.lit(None).cast("boolean")).otherwise(bool_true_tokens(s))
    elif typ == "DATE":
        v = parse_date_multi(s)
    elif typ in ("DATETIME", "TIMESTAMP"):
        v = parse_timestamp_multi(s).cast("timestamp_ntz")
    else:   # STRING keeps inner whitespace and is not trimmed
        v = s if normalized else null_tokens(c.cast("string"))
    spark_type = SPARK_TYPES.get(typ, T.StringType())
    if on_error == "null":
        return v.cast(spark_type)
    d = default if default is not None else _TYPE_DEFAULTS.get(typ)
    return (F.coalesce(v, F.lit(d)) if d is not None else v).cast(spark_type)


def conform(df: DataFrame, registry: Sequence[Field], extras: str = "drop",
            on_error: str = "default", drop: Sequence[str] = ()) -> DataFrame:
    """Registry order, defaults for missing fields, casts for
    present ones; other columns go last (``extras='last'``) or are dropped;
    ``drop`` removes listed columns if present.

    Two projections: every present field is normalised once (trim, null
    tokens), then cast.  Keeping them apart stops the optimizer from inlining
    the normalisation into each of the many parse branches.
    """
    present = [f for f in registry if f.name in set(df.columns) - set(drop)]
    names = {f.name for f in registry}
    extra_cols = [c for c in df.columns if c not in names and c not in set(drop)] if extras == "last" else []
    stage1 = df.select(*[F.col(f"`{c}`") for c in extra_cols],
                       *[(F.col(f"`{f.name}`").cast("string") if f.type.upper() == "STRING"
                          else normalize_text(F.col(f"`{f.name}`"))).alias(f"__n_{i}")
                         for i, f in enumerate(present)])
    idx = {f.name: i for i, f in enumerate(present)}
    sel = []
    for f in registry:
        if f.name in idx:
            src = F.col(f"__n_{idx[f.name]}")
            if f.type.upper() == "STRING":
                out = cast_field(src, f.type, on_error, f.default)
            else:
                out = cast_field(src, f.type, on_error, f.default, normalized=True)
        else:
            out = cast_field(F.lit(None), f.type, on_error, f.default)
        sel.append(out.alias(f.name))
    sel += [F.col(f"`{c}`") for c in extra_cols]
    return stage1.select(*sel)


def reject_counts(df: DataFrame, registry: Sequence[Field]) -> DataFrame:
    """Per registry field present in ``df``, the cells that aren't blank but
    don't fit the field's type (``conform`` gives them the default); one
    aggregate over the table."""
    fields = [f for f in registry if f.name in df.columns and f.type.upper() != "STRING"]
    bad = [F.count_if(~is_blank(normalize_text(F.col(f"`{f.name}`")))
                      & cast_field(F.col(f"`{f.name}`"), f.type, "null").isNull()).alias(f"__{i}")
           for i, f in enumerate(fields)]
    rows = [F.struct(F.lit(f.name).alias("field"), F.lit(f.type).alias("type"), F.col(f"__{i}").alias("rejected"))
            for i, f in enumerate(fields)]
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, type string, rejected bigint")
    return df.agg(*bad).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def stamp(df: DataFrame, always: Mapping[str, object] | None = None,
          if_blank: Mapping[str, object] | None = None) -> DataFrame:
    """constant/audit columns.  ``always`` overwrites; ``if_blank`` fills
    only missing, NULL or blank cells.  Run timestamps are passed in by the
    caller, so reruns are reproducible."""
    out = df
    for c, v in (always or {}).items():
        out = out.withColumn(c, F.lit(v))
    for c, v in (if_blank or {}).items():
        if c in out.columns:
            cur = F.col(c)
            out = out.withColumn(c, F.when(cur.isNull() | (strip(cur.cast("string")) == ""), F.lit(v)).otherwise(cur))
        else:
            out = out.withColumn(c, F.lit(v))
    return out


def fallback_column(df: DataFrame, target: str, keyword: str) -> DataFrame:
    """P10: if ``target`` is absent or wholly blank, copy the first column whose
    name contains ``keyword`` (one single-row aggregate decides)."""
    candidates = [c for c in df.columns if c != target and keyword.lower() in c.lower()]
    if not candidates:
        return df
    if target in df.columns:
        nonblank = df.agg(F.count_if(strip(F.col(target).cast("string")) != "").alias("n")).first()["n"]
        if nonblank:
            return df
    return df.withColumn(target, F.col(f"`{candidates[0]}`"))


# Characters that a table name may not hold, and what takes their place.
NAME_CHARACTERS = str.maketrans({" ": "_", "-": "_", ".": "_", **dict.fromkeys("()[]（）【】", "")})


def sanitize_names(names: Sequence[str]) -> list[str]:
    """Space, ``-`` and ``.`` -> ``_``; brackets dropped; names that start
    with neither a letter (of any script) nor ``_`` get ``col_``; lower case.
    A name that is taken gets the first free ``_n``; names that need no number
    keep theirs."""
    clean = []
    for n in names:
        s = str(n).translate(NAME_CHARACTERS)
        clean.append(("" if not s or s[0] == "_" or s[0].isalpha() else "col_") + s)
    clean = [s.lower() for s in clean]
    taken, out = set(clean), []
    used: set[str] = set()
    for s in clean:
        name, n = s, 0
        while name in used or (n and name in taken):
            n += 1
            name = f"{s}_{n}"
        used.add(name)
        out.append(name)
    return out


def order_columns(columns: Sequence[str], first: Sequence[str] = (), prefixes: Sequence[str] = (),
                  last: Sequence[str] = ()) -> list[str]:
    """``first`` columns, then columns by prefix group, then the rest, then ``last``."""
    cols = list(columns)
    out = [c for c in first if c in cols]
    for p in prefixes:
        out += [c for c in cols if c.startswith(p) and c not in out and c not in last]
    out += [c for c in cols if c not in out and c not in last]
    out += [c for c in last if c in cols]
    return out
