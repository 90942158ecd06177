"""Nearest neighbours by inner product through low-dimensional stable projections.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and a
query gets zero there; the squared distance of the two is |q|^2 + M^2 - 2<q, x>, so
the nearest by distance have the largest inner products.  Gaussian (2-stable)
projections to a few dimensions keep distances up to a chi-square factor: the squared
projected distance over the squared distance is chi-square distributed.

The projections are indexed by one kd-tree over all rows.  Its upper levels, learned on a
bounded sample, cut the rows into cells; a cell of many rows is dealt to blocks, each of
which has the lower levels.  A query walks the leaves by increasing projected distance and verifies
projected neighbours with their vectors, until the stopping test holds for all that is left:

    P(chi2_m <= next projected distance^2 / current k-th distance^2) >= stop.

A query first searches a block of its own cell.  The k-th distance found there tells which
cells can hold projected neighbours that the test does not stop; only these are
visited.  A cell is also left out if its largest norm times the query's is less than the k-th product.

Every row is indexed.  Defined results for unusual input: vectors that are null, zero or
hold null or non-finite components take no part, nor do rows with a null id; rows with
equal ids and vectors count once; of several vectors under one query id the best products
count, and none of them is a neighbour of the others; vectors meet only those of their own
length; ties go to the smaller id; fewer than k candidates: all are returned; no query or no
candidate: an empty table.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.vectors import matrix, takes_part
from helixframe.runtime import bound_batches, materialize

#: Rows of a leaf of the kd-tree.
LEAF = 32
#: Rows that the upper levels are learned on, at most, and rows of the sample that a cell has, at least.
SAMPLE, CELL_SAMPLE = 8192, 8


def chi_square_cdf(x: np.ndarray | float, m: int) -> np.ndarray | float:
    """P(chi2_m <= x) for even m."""
    half = np.asarray(x) / 2
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(m // 2))


@lru_cache
def stop_ratio(m: int, stop: float) -> float:
    """The squared projected distance over the squared k-th distance from which on the stopping test holds."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < stop else (low, mid)
    return high


@lru_cache
def directions(d: int, m: int, seed: int) -> np.ndarray:
    """m Gaussian directions in d dimensions and the lifted one."""
    return np.random.default_rng((seed, d)).standard_normal((d + 1, m))


def project(rows: np.ndarray, top2: float, m: int, seed: int, lifted: bool = True) -> np.ndarray:
    g = directions(rows.shape[1], m, seed)
    lift = np.sqrt(np.maximum(0.0, top2 - (rows * rows).sum(1))) if lifted else np.zeros(len(rows))
    return rows @ g[:-1] + lift[:, None] * g[-1]


def learn_cuts(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """(axis, cut) of a complete tree's inner nodes, level by level: the widest axis at its median."""
    parts, out = [np.arange(len(points))], []
    for _ in range(depth):
        nxt = []
        for part in parts:
            p = points[part] if len(part) else np.zeros((1, points.shape[1]))
            axis = int(np.argmax(np.ptp(p, axis=0)))
            cut = float(np.median(p[:, axis]))
            out.append((axis, cut))
            over = points[part, axis] >= cut
            nxt += [part[~over], part[over]]
        parts = nxt
    return out


def cells_of(points: np.ndarray, cuts: list[tuple[int, float]], depth: int) -> np.ndarray:
    """The cell of each point, by walking down the tree."""
    axis, cut = np.array([a for a, _ in cuts] or [0]), np.array([c for _, c in cuts] or [0.0])
    at = np.zeros(len(points), np.int64)
    for _ in range(depth):
        at = 2 * at + 1 + (points[np.arange(len(points)), axis[at]] >= cut[at])
    return at - (2**depth - 1)


class BlockIndex:
    """kd-tree over the stable projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray):
        order, self.cuts = self._build(points)
        self.ids, self.rows, self.points = ids[order], rows[order], points[order]
        self.low = np.stack([self.points[a:b].min(0) for a, b in self.cuts])
        self.high = np.stack([self.points[a:b].max(0) for a, b in self.cuts])
        #: Vectors verified so far.
        self.verified = 0

    @staticmethod
    def _build(points: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        order, cuts, open_ = np.arange(len(points)), [], [(0, len(points))]
        while open_:
            a, b = open_.pop()
            if b - a <= LEAF:
                cuts.append((a, b))
                continue
            part = points[order[a:b]]
            axis, mid = int(np.argmax(np.ptp(part, axis=0))), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
            open_ += [(a, a + mid), (a + mid, b)]
        return order, sorted(cuts)

    def search(self, qid: int, q: np.ndarray, at: np.ndarray, top2: float, k: int, ratio: float, least: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k rows of the block but the query's own, among those with products of ``least`` or more."""
        gap = np.maximum(0.0, np.maximum(self.low - at, at - self.high))
        bound = (gap * gap).sum(1)
        leaves = np.argsort(bound, kind="stable")
        q2, ids, scores, i, step = float(q @ q), np.empty(0, np.int64), np.empty(0), 0, 2
        far = ratio * max(1e-300, q2 + top2 - 2 * least)
        while i < len(leaves) and bound[leaves[i]] <= far:
            part = leaves[i : i + step]
            rows = np.concatenate([np.arange(*self.cuts[x]) for x in part])
            off = self.points[rows] - at
            rows = rows[(off * off).sum(1) <= far]
            # Row sums in a fixed order: equal vectors get equal scores wherever they stand.
            s = (self.rows[rows] * q).sum(1)
            self.verified += len(rows)
            own = self.ids[rows]
            good = (own != qid) & (s >= least)
            ids, scores = np.concatenate((ids, own[good])), np.concatenate((scores, s[good]))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) >= k:
                least = max(least, scores[k - 1])
                far = ratio * max(1e-300, q2 + top2 - 2 * least)
            i, step = i + step, min(64, step * 2)
        return ids, scores


def nearest(vectors: DataFrame, is_query: Column, id: str = "vec_id", vec: str = "embedding", k: int = 20, dims: int = 16, stop: float = 0.92, block_rows: int = 16384, query_rows: int = 4096, seed: int = 11) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k nearest by inner product among all other rows."""
    bound_batches(vectors.sparkSession)
    v = F.col(f"`{vec}`")
    rows = vectors.where(takes_part(v) & F.col(f"`{id}`").isNotNull())
    rows = rows.select(F.col(f"`{id}`").cast("bigint").alias("i"), v.cast("array<double>").alias("v"), is_query.alias("q")).dropDuplicates(["i", "v"])
    rows = rows.withColumn("d", F.size("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    seen = rows.agg(F.count("*").alias("n"), F.max(norm2).alias("top")).first()
    top2, ratio = float(seen["top"] or 0.0), stop_ratio(dims, stop)

    # The upper levels of the tree, for each length of vectors.
    drawn = rows.orderBy(F.xxhash64("i", "v")).limit(SAMPLE).select("v", "d").collect()
    most = int(math.log2(max(1, SAMPLE // CELL_SAMPLE)))
    depth = min(most, max(0, math.ceil(math.log2(max(1, seen["n"]) / block_rows))))
    cuts = {d: learn_cuts(project(np.array([r["v"] for r in drawn if r["d"] == d]), top2, dims, seed), depth) for d in {r["d"] for r in drawn}}

    def place(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for d in set(table["d"].to_pylist()):
                part = table.filter(pc.equal(table["d"], d))
                x = matrix(part["v"])
                points = project(x, top2, dims, seed)
                cell = cells_of(points, cuts[d], depth) if d in cuts else np.zeros(len(x), np.int64)
                made = pa.table({"i": part["i"], "v": part["v"], "q": part["q"], "d": part["d"], "p": pa.array(list(points), pa.list_(pa.float64())), "m2": pa.array((x * x).sum(1)), "cell": pa.array(cell)})
                yield from made.to_batches()

    placed = materialize(rows.mapInArrow(place, "i long, v array<double>, q boolean, d int, p array<double>, m2 double, cell long"), "projected")
    key = ["d", "cell"]
    box = [f(F.col("p")[x]).alias(f"{name}{x}") for name, f in (("low", F.min), ("high", F.max)) for x in range(dims)]
    # As many rows as cells and lengths of vectors.
    boxes = placed.groupBy(*key).agg(F.count("*").alias("n"), F.max("m2").alias("m2"), *box).collect()
    by_length: dict[int, tuple] = {}
    for d in {r["d"] for r in boxes}:
        own = [r for r in boxes if r["d"] == d]
        corner = lambda name: np.array([[r[f"{name}{x}"] for x in range(dims)] for r in own])  # noqa: B023, E731
        by_length[d] = (np.array([r["cell"] for r in own]), corner("low"), corner("high"), np.sqrt([r["m2"] for r in own]), np.array([-(-r["n"] // block_rows) for r in own]))
    sizes = vectors.sparkSession.createDataFrame([(r["d"], r["cell"], -(-r["n"] // block_rows)) for r in boxes], "d int, cell long, subs long")
    blocked = placed.join(F.broadcast(sizes), key).withColumn("sub", F.pmod(F.xxhash64("i", "v"), F.col("subs")))
    cands = blocked.select("d", "cell", "sub", "i", "v", "p")
    first = blocked.where("q").select("d", "cell", "sub", "i", "v", F.lit(float("-inf")).alias("least"))

    found_schema = "i long, v array<double>, d int, cell long, sub long, ids array<long>, scores array<double>"

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.rename_columns([c[2:] for c in right.column_names])
        cols: dict[str, list] = {"ids": [], "scores": []}
        if left.num_rows and right.num_rows:
            index, asked = BlockIndex(left["i"].to_numpy(), matrix(left["v"]), matrix(left["p"])), matrix(right["v"])
            at = project(asked, top2, dims, seed, lifted=False)
            for n, (x, least) in enumerate(zip(right["i"].to_pylist(), right["least"].to_pylist(), strict=True)):
                ids, scores = index.search(x, asked[n], at[n], top2, k, ratio, least)
                cols["ids"].append(ids)
                cols["scores"].append(scores)
        else:
            right = right.slice(0, 0)
        named = {c: right[c] for c in ("i", "v", "d", "cell", "sub")} if right.num_rows else {c: pa.array([], t) for c, t in (("i", pa.int64()), ("v", pa.list_(pa.float64())), ("d", pa.int32()), ("cell", pa.int64()), ("sub", pa.int64()))}
        return pa.table({**named, "ids": pa.array(cols["ids"], pa.list_(pa.int64())), "scores": pa.array(cols["scores"], pa.list_(pa.float64()))})

    def search(asked: DataFrame) -> DataFrame:
        """Queries meet the blocks that they ask, in groups of about ``query_rows``."""
        block = ["d", "cell", "sub"]
        groups = asked.groupBy(*block).agg(F.ceil(F.count("*") / query_rows).alias("gs"))
        left = cands.join(groups, block).withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("gs") - 1))).drop("gs")
        right = asked.join(groups, block).withColumn("g", F.pmod(F.xxhash64("i", "v"), F.col("gs"))).drop("gs")
        right = right.select(*(F.col(c).alias(f"q_{c}") for c in right.columns))
        return left.groupBy(*block, "g").cogroup(right.groupBy(*(f"q_{c}" for c in (*block, "g")))).applyInArrow(meet, found_schema)

    near = materialize(search(first), "near")

    def visits(batches):
        """The blocks that a query has yet to visit."""
        for batch in batches:
            out: dict[str, list] = {"n": [], "cell": [], "sub": [], "least": []}
            for n, (q, d, cell, sub, scores) in enumerate(zip(batch["v"], batch["d"].to_pylist(), batch["cell"].to_pylist(), batch["sub"].to_pylist(), batch["scores"].to_pylist(), strict=True)):
                q = q.values.to_numpy()
                names, low, high, norm, subs = by_length[d]
                least = scores[k - 1] if len(scores) >= k else -math.inf
                q2, at = float(q @ q), project(q[None], top2, dims, seed, lifted=False)[0]
                gap = np.maximum(0.0, np.maximum(low - at, at - high))
                open_ = ((gap * gap).sum(1) <= ratio * max(1e-300, q2 + top2 - 2 * least)) & (math.sqrt(q2) * norm * (1 + 1e-9) >= least)
                for c, s in zip(names[open_].tolist(), subs[open_].tolist(), strict=True):
                    todo = [x for x in range(s) if (c, x) != (cell, sub)]
                    out["n"] += [n] * len(todo)
                    out["cell"] += [c] * len(todo)
                    out["sub"] += todo
                    out["least"] += [least] * len(todo)
            at = pa.array(out["n"], pa.int64())
            made = pa.table({"d": batch["d"].take(at), "cell": pa.array(out["cell"], pa.int64()), "sub": pa.array(out["sub"], pa.int64()), "i": batch["i"].take(at), "v": batch["v"].take(at), "least": pa.array(out["least"], pa.float64())})
            yield from made.to_batches(max_chunksize=1000)

    more = search(near.mapInArrow(visits, "d int, cell long, sub long, i long, v array<double>, least double"))
    pairs = near.unionByName(more).select(F.col("i").alias("query_id"), F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    found = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
