"""Nearest neighbours with a vantage-point tree per shard.

A small vantage-point tree over a sample routes every vector to a shard of near
ones, so that the triangle inequality can leave out whole shards; each shard
has a tree of its own over all its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import stored

SHARD_ROWS = 8192           # vectors of one tree, about
LEAF = 48
VALUES = 1 << 20            # components compared at a time
QUERY_BLOCK = 512           # queries that walk a tree together
GROUP_QUERIES = 16_384      # queries that meet one tree in one group, about
SLIP = 1e-9                 # of rounding, added to every bound, relative to the distance
MAX_DIMS = 100_000          # dimensions have one small row each, broadcast up to that many
ROUTED_DIMS = 16            # dimensions with a router, those of most vectors; the others' shards are dealt by a hash
MAX_LEVELS = 12             # of a router, which has 2^levels leaves; larger leaves are several shards
SAMPLE_VALUES = 4_000_000   # components of the vectors that all routers are built from (the sample's bound)
LEAF_SAMPLE = 8             # sampled vectors of a router's leaf, at least


def distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - point) ** 2).sum(axis=-1))


class Tree:
    """Vantage-point tree over rows of ``vectors``, which it reorders.

    A node takes the first of its rows as vantage point and halves the others
    by their distance rank, so equal vectors can't make it deep; each half
    keeps the interval of its distances.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, bounds: dict[int, tuple] | None = None):
        """``bounds`` (of the node that begins at a place) belong to rows that are in tree order already."""
        self.nodes: list[tuple] = []        # (begin, end, near child, far child, near low, high, far low, high)
        if bounds is None:
            order = np.argsort(ids, kind="stable")
            self.vectors, self.ids = vectors[order], ids[order]
            self.order = np.random.Generator(np.random.PCG64(len(ids))).permutation(len(ids))
        else:
            self.vectors, self.ids, self.order = vectors, ids, np.arange(len(ids))
        self._build(0, len(ids), bounds)
        self.squares = (self.vectors ** 2).sum(axis=-1)

    def _build(self, begin: int, end: int, known: dict[int, tuple] | None) -> int:
        at = len(self.nodes)
        self.nodes.append((begin, end, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if end - begin > LEAF:
            half = (end - begin - 1) // 2
            if known is None:
                rest = self.order[begin + 1:end]
                d = distances(self.vectors[rest], self.vectors[self.order[begin]])
                rank = np.argsort(d, kind="stable")
                self.order[begin + 1:end], d = rest[rank], d[rank]
                bounds = (d[0], d[half - 1], d[half], d[-1])
            else:
                bounds = known[begin]
            near = self._build(begin + 1, begin + 1 + half, known)
            far = self._build(begin + 1 + half, end, known)
            self.nodes[at] = (begin, end, near, far, *bounds)
        return at

    def bounds(self) -> dict[int, tuple]:
        """The intervals of every inner node by the place where it begins."""
        return {n[0]: n[4:] for n in self.nodes if n[2] >= 0}

    def _limits(self, queries: np.ndarray, own: np.ndarray, k: int, limit: np.ndarray) -> np.ndarray:
        """The k-th distance in the likeliest node of at least 4 k rows, where it is below ``limit``."""
        limit, left = limit.copy(), [(0, np.flatnonzero(np.isinf(limit)))]
        while left:
            node, which = left.pop()
            begin, end, near, far, a, b, c, e = self.nodes[node]
            if near >= 0 and end - begin > max(LEAF, 8 * k):
                inner = distances(queries[which], self.vectors[self.order[begin]]) <= (b + c) / 2
                left += [(child, part) for child, part in ((near, which[inner]), (far, which[~inner])) if len(part)]
                continue
            rows = self.order[begin:end]
            for part in np.array_split(which, len(which) * self.vectors[rows].size // VALUES + 1):
                d = distances(self.vectors[rows][None, :, :], queries[part][:, None, :])
                d = np.where(self.ids[rows][None, :] == own[part][:, None], np.inf, d)
                if d.shape[1] >= k:
                    limit[part] = np.minimum(limit[part], np.partition(d, k - 1, axis=1)[:, k - 1])
        return limit

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float,
               limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(distances, ids) of the k nearest rows of each query but its own id,
        padded with inf and the largest id.  Rows beyond a query's ``limit`` may be left out.

        A first descent to the likeliest node of a few rows bounds the k-th
        distance, so that one visit of each node serves all queries that need it.
        A half is visited unless its interval's distance to the query's exceeds
        the k-th distance so far divided by ``factor``; factor 1 loses nothing.
        """
        q = len(queries)
        best_d = np.full((q, k), np.inf)
        best_i = np.full((q, k), np.iinfo(np.int64).max)
        limit = np.full(q, np.inf) if limit is None else limit
        squares = (queries ** 2).sum(axis=-1)

        def bar(which: np.ndarray) -> np.ndarray:
            return np.minimum(best_d[which, -1], limit[which])

        def near_pairs(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
            """Distances of rows that may be near enough, by a product first; inf for the others."""
            both = squares[which][:, None] + self.squares[rows][None, :]
            about = both - 2 * (queries[which] @ self.vectors[rows].T)
            with np.errstate(invalid="ignore"):
                at, row = np.nonzero(~(about > bar(which)[:, None] ** 2 * (1 + SLIP) + SLIP * both))
            d = np.full(about.shape, np.inf)
            step = VALUES // queries.shape[1] + 1
            for x in range(0, len(at), step):
                i, j = at[x:x + step], row[x:x + step]
                d[i, j] = distances(self.vectors[rows[j]], queries[which[i]])
            return d

        def offer(rows: np.ndarray, which: np.ndarray, d: np.ndarray) -> None:
            d = np.where(self.ids[rows][None, :] == own[which][:, None], np.inf, d)
            better = (d <= bar(which)[:, None]).any(axis=1)
            if not better.any():
                return
            which, d = which[better], d[better]
            all_d = np.concatenate([best_d[which], d], axis=1)
            all_i = np.concatenate([best_i[which], np.where(np.isinf(d), np.iinfo(np.int64).max, self.ids[rows][None, :])],
                                   axis=1)
            first = np.lexsort((all_i, all_d), axis=1)[:, :k]
            best_d[which] = np.take_along_axis(all_d, first, 1)
            best_i[which] = np.take_along_axis(all_i, first, 1)

        def walk(node: int, which: np.ndarray) -> None:
            begin, end, near, far, a, b, c, e = self.nodes[node]
            if near < 0:
                rows = self.order[begin:end]
                offer(rows, which, near_pairs(rows, which))
                return
            rows = self.order[begin:begin + 1]
            d = distances(queries[which], self.vectors[rows[0]])
            offer(rows, which, d[:, None])
            for child, low, high in ((near, a, b), (far, c, e)):
                gap = np.maximum(0, np.maximum(low - d, d - high))
                go = gap <= bar(which) / factor + SLIP * (1 + d)
                if go.any():
                    walk(child, which[go])

        if len(self.ids) and q:
            limit = self._limits(queries, own, k, limit) * (1 + SLIP)
            walk(0, np.arange(q))
        return best_d, best_i


class Router:
    """A complete vantage-point tree of ``levels`` levels over a sample: node n
    has children 2n (distance at most ``cut``) and 2n + 1, leaves count from 0."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        self.points = np.zeros((1 << levels, sample.shape[1]))
        self.cut = np.zeros(1 << levels)
        parts = {1: np.arange(len(sample))}
        for node in range(1, 1 << levels):
            rows = parts.pop(node)
            near = np.zeros(0, bool)
            if len(rows):               # without samples any point is right, only not balanced
                self.points[node] = sample[rows[0]]
                d = distances(sample[rows], self.points[node])
                self.cut[node] = np.median(d)
                near = d <= self.cut[node]
            parts[2 * node], parts[2 * node + 1] = rows[near], rows[~near]

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distances to the vantage points on the way) of each row."""
        node = np.ones(len(vectors), np.int64)
        path = np.zeros((len(vectors), self.levels))
        for level in range(self.levels):
            path[:, level] = distances(vectors, self.points[node])
            node = 2 * node + (path[:, level] > self.cut[node])
        return node - (1 << self.levels), path

    def ways(self) -> np.ndarray:
        """The node of each leaf (row) at each level (column)."""
        leaf = np.arange(1 << self.levels)[:, None] + (1 << self.levels)
        return leaf >> (self.levels - np.arange(self.levels)[None, :])

    def gaps(self, vectors: np.ndarray, leaves: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least distance to any row of each of ``leaves``, rounding it may hold): the
        largest gap between a query's distances and a leaf's intervals ``low`` to ``high``."""
        ways, gap, slack = self.ways()[leaves], 0.0, 0.0
        for level in range(self.levels):
            first = 1 << level
            d = distances(vectors[:, None, :], self.points[None, first:2 * first, :])[:, ways[:, level] - first]
            gap = np.maximum(gap, np.maximum(low[:, level] - d, d - high[:, level]))
            slack = np.maximum(slack, SLIP * (1 + d))
        return np.broadcast_to(gap, (len(vectors), len(leaves))), np.broadcast_to(slack, (len(vectors), len(leaves)))


def usable(vec) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, np.float64) for v in vectors]).reshape(-1, dim)


def _routed(routers: dict[int, Router]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            leaf, path = np.zeros(len(b), np.int32), [[]] * len(b)
            for dim in set(b["_dim"]) & routers.keys():
                at = np.flatnonzero(b["_dim"].to_numpy() == dim)
                leaf[at], there = routers[dim].route(_matrix(b.vec.iloc[at], dim))
                for row, way in zip(at, there, strict=True):
                    path[row] = way
            yield b.assign(_leaf=leaf, _path=path)
    return run


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's rows in tree order, with the intervals of the nodes that begin at them."""
    rows = rows.sort_values(["vec_id", "_row"], kind="stable", ignore_index=True)
    tree = Tree(_matrix(rows.vec, len(rows.vec.iloc[0])), rows.vec_id.to_numpy(np.int64))
    out, bounds = rows.iloc[tree.order], tree.bounds()
    return out.assign(_at=np.arange(len(out)), _bounds=[bounds.get(k) for k in range(len(out))])[
        ["_dim", "_leaf", "_sub", "_at", "_bounds", "vec_id", "vec"]]


TREE_SCHEMA = "_dim int, _leaf int, _sub int, _at int, _bounds array<double>, vec_id long, vec array<double>"
SHARD = ["_dim", "_leaf", "_sub", "_block"]


def _search(k: int, factor: float):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"_q": np.zeros(0, np.int64), "query_id": np.zeros(0, np.int64),
                               "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(rows) and len(queries):
            rows = rows.sort_values("_at", ignore_index=True)
            dim = len(rows.vec.iloc[0])
            tree = Tree(_matrix(rows.vec, dim), rows.vec_id.to_numpy(np.int64),
                        {k: tuple(b) for k, b in enumerate(rows["_bounds"]) if b is not None})
            number, ids = queries["_q"].to_numpy(np.int64), queries.query_id.to_numpy(np.int64)
            vectors, limit = _matrix(queries.vec, dim), queries["_limit"].to_numpy(np.float64)
            for at in range(0, len(ids), QUERY_BLOCK):
                part = slice(at, at + QUERY_BLOCK)
                d, i = tree.search(vectors[part], ids[part], k, factor, limit[part])
                there = np.isfinite(d)
                found.append(pd.DataFrame({"_q": np.repeat(number[part], k)[there.ravel()], "vec_id": i[there],
                                           "query_id": np.repeat(ids[part], k)[there.ravel()], "score": d[there]}))
        return pd.concat(found)[["_q", "query_id", "vec_id", "score"]]
    return run


def _reached(routers: dict[int, Router], intervals: dict[int, tuple], factor: float):
    """Adds to each query the leaves, but its own, that may hold a row within its limit."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            reach = [[]] * len(b)
            for dim in set(b["_dim"]) & intervals.keys():
                leaves, low, high = intervals[dim]
                rows = np.flatnonzero(b["_dim"].to_numpy() == dim)
                for at in range(0, len(rows), 16):
                    part = rows[at:at + 16]
                    gap, slack = routers[dim].gaps(_matrix(b.vec.iloc[part], dim), leaves, low, high)
                    go = gap <= b["_limit"].to_numpy()[part][:, None] / factor + slack
                    go &= leaves[None, :] != b["_leaf"].to_numpy()[part][:, None]
                    for row, mask in zip(part, go, strict=True):
                        reach[row] = leaves[mask]
            yield b.assign(_reach=reach)
    return run


def _routers(own: DataFrame, shard_rows: int) -> dict[int, Router]:
    """One router for each of the dimensions of most vectors, from a sample of bounded size."""
    large = [(r["_dim"], r["n"]) for r in own.groupBy("_dim").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > shard_rows).orderBy(F.desc("n"), "_dim").limit(ROUTED_DIMS).collect()]
    plan, most = {}, F.lit(0)
    for dim, n in large:
        levels = min(MAX_LEVELS, int(np.ceil(np.log2(n / shard_rows))))
        sample = SAMPLE_VALUES // (dim * len(large))
        while levels and LEAF_SAMPLE << levels > sample:
            levels -= 1
        if levels:
            plan[dim] = levels, min(sample, LEAF_SAMPLE * 4 << levels)
            most = F.when(F.col("_dim") == dim, plan[dim][1]).otherwise(most)
    if not plan:
        return {}
    mixed = Window.partitionBy("_dim").orderBy(F.xxhash64("_row"), "_row")
    rows = (own.filter(F.col("_dim").isin(list(plan))).withColumn("_k", F.row_number().over(mixed))
            .filter(F.col("_k") <= SAMPLE_VALUES).filter(F.col("_k") <= most).select("_dim", "_k", "vec").toPandas())
    return {dim: Router(_matrix(rows[rows["_dim"] == dim].sort_values("_k").vec, dim), levels)
            for dim, (levels, _) in plan.items()}


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest of ``vectors`` (vec_id, vec) for each of ``queries``
    (query_id, vec), by Euclidean distance in double precision: query_id, rank,
    vec_id, score; ties to the smaller vec_id, a query's own id left out.

    Every usable row is in one tree.  Per dimension, a router (a vantage-point
    tree over a bounded sample) sends each row to a leaf; leaves of more than
    ``shard_rows`` rows, such as those of many equal vectors, are several shards
    by a hash of the row's number.  Each shard's tree is built once and written.
    A query first meets its own leaf; the k-th distance found there, and the
    intervals of distances that each leaf keeps to the router's points, choose
    the other leaves that it meets.  Queries meet a shard in blocks of about
    GROUP_QUERIES, so a group has a bounded size on both sides; a shard returns
    at most k rows a query.  ``factor`` 1 is exact; larger factors prune more,
    leaves as well as nodes.  Unusable vectors (see ``usable``) take no part.
    Rows that share a vec_id are neighbours each; the different vectors of a
    query_id are all asked, and its k nearest are those of all of them.  Columns
    but the two of each table are ignored.  An empty table gives no rows.
    """
    own = stored(vectors.filter(usable(F.col("vec"))).filter("vec_id IS NOT NULL").select(
        "vec_id", "vec", F.size("vec").alias("_dim"), F.monotonically_increasing_id().alias("_row")), "vp-vectors")
    asked = stored(queries.filter(usable(F.col("vec"))).filter("query_id IS NOT NULL").select("query_id", "vec")
                   .distinct().select("query_id", "vec", F.size("vec").alias("_dim"),
                                      F.monotonically_increasing_id().alias("_q")), "vp-queries")
    routers = _routers(own, shard_rows)
    placed = stored(own.mapInPandas(
        _routed(routers), "vec_id long, vec array<double>, _dim int, _row long, _leaf int, _path array<double>"), "vp-placed")
    asked = stored(asked.mapInPandas(
        _routed(routers), "query_id long, vec array<double>, _dim int, _q long, _leaf int, _path array<double>")
        .drop("_path"), "vp-asked")
    sides = [f(F.get("_path", F.lit(j))).alias(f"_{f.__name__}{j}") for f in (F.min, F.max) for j in range(MAX_LEVELS)]
    leaves = stored(placed.groupBy("_dim", "_leaf").agg(F.count(F.lit(1)).alias("_n"), *sides), "vp-leaves")
    intervals = {}
    if routers:                                     # at most ROUTED_DIMS * 2^MAX_LEVELS rows
        kept = leaves.filter(F.col("_dim").isin(list(routers))).toPandas()
        for dim, r in routers.items():
            here = kept[kept["_dim"] == dim].sort_values("_leaf")
            intervals[dim] = (here["_leaf"].to_numpy(), *(
                here[[f"_{f}{j}" for j in range(r.levels)]].to_numpy(np.float64) for f in ("min", "max")))
    most_leaves = MAX_DIMS + (ROUTED_DIMS << MAX_LEVELS)
    subs = leaves.select("_dim", "_leaf", F.ceil(F.col("_n") / shard_rows).cast("int").alias("_subs"))
    subs = sized_broadcast(subs, most_leaves)
    trees = stored(placed.drop("_path").join(subs, ["_dim", "_leaf"])
                   .withColumn("_sub", F.pmod(F.xxhash64("_row"), F.col("_subs")).cast("int")).drop("_subs")
                   .groupBy("_dim", "_leaf", "_sub").applyInPandas(_built, TREE_SCHEMA), "vp-trees")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))           # noqa: E731

    def met(which: DataFrame) -> DataFrame:
        """The rows found for queries that meet the leaf of their row."""
        blocks = stored(which.groupBy("_dim", "_leaf").agg(
            F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("_blocks")), "vp-blocks")
        blocks = sized_broadcast(blocks, most_leaves)
        rows = trees.join(blocks, ["_dim", "_leaf"]).withColumn("_block", numbers("_blocks"))
        sent = (which.join(blocks, ["_dim", "_leaf"]).join(subs, ["_dim", "_leaf"])
                .withColumn("_block", F.pmod(F.xxhash64("_q"), F.col("_blocks")).cast("int"))
                .withColumn("_sub", numbers("_subs")))
        return (rows.select(*SHARD, "_at", "_bounds", "vec_id", "vec").groupBy(*SHARD)
                .cogroup(sent.select(*SHARD, "_q", "query_id", "vec", "_limit").groupBy(*SHARD))
                .applyInPandas(_search(k, factor), "_q long, query_id long, vec_id long, score double"))

    nearby = Window.partitionBy("_q").orderBy("score", "vec_id")
    found = stored(met(asked.withColumn("_limit", F.lit(float("inf")))).withColumn("_k", F.row_number().over(nearby))
                   .filter(F.col("_k") <= k).drop("_k"), "vp-found")
    if intervals:
        limit = found.groupBy("_q").agg(F.count(F.lit(1)).alias("_n"), F.max("score").alias("_far"))
        limited = asked.join(limit, "_q", "left").select(
            "_q", "query_id", "vec", "_dim", "_leaf",
            F.when(F.col("_n") >= k, F.col("_far")).otherwise(float("inf")).alias("_limit"))
        reach = limited.mapInPandas(_reached(routers, intervals, factor), "_q long, query_id long, vec array<double>, "
                                    "_dim int, _leaf int, _limit double, _reach array<int>")
        reach = stored(reach.withColumn("_leaf", F.explode("_reach")).drop("_reach"), "vp-reach")
        found = found.unionByName(met(reach))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
