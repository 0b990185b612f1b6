"""Randomised comparison of two intricate rules with small pure-Python models
of their specification (SURVEY §2.4 J8/J9, §2.6 W7)."""

import random

from orderlake.operators import enrich
from orderlake.operators import sequence as sq


def cascade_model(code, keys_in_order):
    """Resolve ``code`` against master keys (in master order); (key, stage)."""
    keys = set(keys_in_order)
    n = len(code)
    cands = [(1, code)]
    if n < 15:
        cands += [(2, code.rjust(15, "0")), (3, code.ljust(15, "0")), (4, code.rjust(14, "0").ljust(15, "0"))]
    stripped = code.lstrip("0")
    if stripped and stripped != code:
        cands.append((5, stripped))
    for i, width in enumerate(range(10, 16)):
        if n < width:
            cands += [(6 + 2 * i, code.rjust(width, "0")), (7 + 2 * i, code.ljust(width, "0"))]
    for stage, c in cands:
        if c in keys:
            return c, stage
    if n >= 8:
        for k in keys_in_order:
            if k.startswith(code) or code.startswith(k):
                return k, 18
    return None, None


def test_cascade_matches_model(spark):
    rnd = random.Random(7)
    digits = "0123456789"
    keys = []
    for _ in range(120):
        k = "".join(rnd.choice(digits) for _ in range(rnd.choice([8, 10, 11, 12, 13, 14, 15])))
        keys.append(k if rnd.random() < 0.7 else "000" + k[3:])
    keys = list(dict.fromkeys(keys))
    codes = []
    for _ in range(400):
        k = rnd.choice(keys)
        form = rnd.randrange(7)
        codes.append([k, k.lstrip("0") or k, k[:-1], k + rnd.choice(digits), k[: rnd.randint(6, len(k))],
                      "".join(rnd.choice(digits) for _ in range(rnd.randint(3, 16))), k.rstrip("0") or k][form])
    master = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, pos int")
    fact = spark.createDataFrame([(c,) for c in codes], "code string")
    got = {r["code"]: (r["m"], r["s"]) for r in
           enrich.lookup_cascade(fact, master, "code", "k", "pos", out="m", stage="s").collect()}
    for c in set(codes):
        assert got[c] == cascade_model(c, keys), c


def runs_model(rows, prefix="RM"):
    """rows: (date, recipient, id) -> {row: number} following the W7 rule."""
    def num(x):
        t = x.replace(prefix, "").strip()
        body = t[1:] if t[:1] in "+-" else t
        return int(t) if body.isdigit() else None
    out, prev, cur = {}, None, 0
    for r in sorted(rows):
        d, rec, sn = r
        new = prev is None or d != prev[0] or rec != prev[1]
        if not new and prev[2] and sn:
            a, b = num(prev[2]), num(sn)
            new = a is None or b is None or b != a + 1
        cur = 1 if new else cur + 1
        out[r] = str(cur)
        prev = r
    return out


def test_runs_match_model(spark):
    rnd = random.Random(11)
    rows = set()
    for _ in range(600):
        base = rnd.randint(1000, 1040)
        sn = rnd.choice([f"RM{base}", f"RM{base}", f"RM{base + 1}", "", "RMABC", f"{base}"])
        rows.add((rnd.choice(["2025-07-01", "2025-07-02"]), rnd.choice(["Amy", "Bob", "Cy"]), sn))
    rows = sorted(rows)
    df = spark.createDataFrame(rows, "d string, r string, sn string")
    want = runs_model(rows)
    for method in ("scan", "window"):
        got = {(x["d"], x["r"], x["sn"]): x["n"] for x in
               sq.consecutive_runs(df, "d", "r", "sn", out="n", partitions=5, method=method).collect()}
        assert got == want, method
