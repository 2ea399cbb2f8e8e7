"""Approximate nearest neighbours with vantage-point trees.

Vectors are put on the unit sphere, where the order by distance is the order by cosine. A small tree of vantage points, fitted
on a bounded sample, divides the sphere into cells; every row belongs to one, and large cells are cut into shards by id, so no
task holds a cell. A shard is a vantage-point tree of its own: each node knows a point and how near and how far the rows of
either side are from it, which by the triangle inequality bounds how near they can be to a query.

A query first searches its own cell; its k-th distance then tells which other cells it must look into. A cell or subtree is
left out when its bound times ``factor`` exceeds the k-th distance: with factor 1 the search is exact, a larger factor leaves
out more. What is found is scored on the original vectors, in double precision.

Queries are stated rows (every ``EVERY``-th id); they meet the shards in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wattfold.llm import meetings as M, texts as T

EVERY, NEIGHBOURS, FACTOR = 50, 5, 1.0
#: Vectors of the sample; rows of a cell on average and of a shard at most; levels of the tree of cells at most; rows of a leaf.
SAMPLE, CELL, SHARD, LEVELS, LEAF = 8192, 4096, 8192, 10, 96
#: Queries that look into a shard in one task, and how many are compared at a time.
LOOKING, BLOCK = 16_384, 1024
#: Distances are off by less than this.
SLACK = 1e-6
_SENT = "size int, cell int, sub int, salt int, looks int, vec_id long, twin long, vector binary, tau double"


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Between unit vectors, each of x with each of y."""
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, which changes no cosine and keeps squares within range."""
    _, e = np.frexp(np.abs(x).max(1))
    return np.ldexp(x, -e[:, None])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


class Cells:
    """A perfect binary tree of vantage points; leaf i of the lowest level is cell i."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        n = 2**levels - 1
        self.points, self.radius = np.zeros((max(n, 1), sample.shape[1])), np.zeros(max(n, 1))
        held = {0: np.arange(len(sample))}
        for node in range(n):
            own = held.pop(node)
            self.points[node] = sample[own[len(own) // 2]] if len(own) else sample[node % len(sample)]
            d = distances(sample[own], self.points[node : node + 1])[:, 0]
            self.radius[node] = np.median(d) if len(own) else 1.0
            held[2 * node + 1], held[2 * node + 2] = own[d <= self.radius[node]], own[d > self.radius[node]]
        #: The nodes above each cell, from the root down.
        self.above = np.zeros((2**levels, levels), int)
        for k in range(levels):
            self.above[:, k] = 2**k - 1 + (np.arange(2**levels) >> (levels - k))

    def placed(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row, and its distances to all points."""
        d = distances(unit, self.points)
        node = np.zeros(len(unit), int)
        for _ in range(self.levels):
            node = 2 * node + 1 + (d[np.arange(len(unit)), node] > self.radius[node])
        return node - (2**self.levels - 1), d


class Layout:
    """The cells of each length of vectors, and what is known of them: members, and their least and largest distance to the points above."""

    def __init__(self, cells: dict[int, Cells]):
        self.cells = cells
        self.members: dict[tuple[int, int], int] = {}
        self.looking: dict[tuple[int, int], int] = {}
        self.low = {n: np.full((2**c.levels, c.levels), np.inf) for n, c in cells.items()}
        self.high = {n: np.full((2**c.levels, c.levels), -np.inf) for n, c in cells.items()}

    def placed(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        cells = self.cells.get(unit.shape[1])
        return (np.zeros(len(unit), int), None) if cells is None else cells.placed(unit)

    def shards(self, size: int, cell: int) -> int:
        return max(1, -(-self.members.get((size, cell), 0) // SHARD))

    def salts(self, size: int, cell: int) -> int:
        return max(1, -(-self.looking.get((size, cell), 0) // LOOKING))

    def reached(self, size: int, d: np.ndarray | None, tau: np.ndarray, factor: float) -> np.ndarray:
        """Which cells a query must look into, a row a query."""
        if d is None:
            return np.ones((len(tau), 1), bool)
        cells, low, high = self.cells[size], self.low[size], self.high[size]
        least = np.zeros((len(tau), 2**cells.levels))
        for k in range(cells.levels):
            own = d[:, cells.above[:, k]]
            np.maximum(least, np.maximum(low[:, k] - own, own - high[:, k]), out=least)
        return np.isfinite(least) & (least * factor <= tau[:, None] + SLACK)


class Tree:
    """A vantage-point tree over unit vectors."""

    def __init__(self, unit: np.ndarray, rows: np.ndarray | None = None):
        rows = np.arange(len(unit)) if rows is None else rows
        self.rows, self.sides = rows, []
        if len(rows) <= LEAF:
            return
        self.point = unit[rows[len(rows) // 2]]
        d = distances(unit[rows], self.point[None])[:, 0]
        self.radius = np.median(d)
        near = d <= self.radius
        if near.all():
            return  # equal vectors are one leaf
        for side in (near, ~near):
            self.sides.append((d[side].min(), d[side].max(), Tree(unit, rows[side])))


class Search:
    """The nearest members of a shard for a block of queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, tree: Tree, unit: np.ndarray, k: int, factor: float):
        self.ids, self.x, self.norm, self.tree, self.unit, self.k, self.factor = ids, x, norms(x), tree, unit, k, factor

    def run(self, ids: np.ndarray, x: np.ndarray, tau: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, member, score) of at most k members of each query, those with a cosine below the bound ``tau`` left out."""
        self.own, self.q, self.q_norm, self.tau = ids, x, norms(x), tau.copy()
        self.q_unit = x / self.q_norm[:, None]
        self.score, self.found = np.full((len(ids), self.k), -np.inf), np.full((len(ids), self.k), -1)
        self.seeded = np.full(len(ids), -1)
        free = np.flatnonzero(np.isinf(tau))
        if len(free) and self.tree.sides:
            self._seed(self.tree, free)
        self._visit(self.tree, np.arange(len(ids)))
        q, j = np.nonzero(self.found >= 0)
        return q, self.found[q, j], self.score[q, j]

    def _seed(self, node: Tree, active: np.ndarray) -> None:
        """Brings each query to its own leaf, so that the search starts with a bound."""
        if not len(active):
            return
        if not node.sides:
            self._compare(node, active)
            self.seeded[active] = id(node)
            return
        near = distances(self.q_unit[active], node.point[None])[:, 0] <= node.radius
        for own, (_, _, child) in zip((near, ~near), node.sides):
            self._seed(child, active[own])

    def _visit(self, node: Tree, active: np.ndarray) -> None:
        if not node.sides:
            self._compare(node, active[self.seeded[active] != id(node)])
            return
        d = distances(self.q_unit[active], node.point[None])[:, 0]
        for low, high, child in node.sides:
            go = np.maximum(low - d, d - high) * self.factor <= self.tau[active] + SLACK
            if go.any():
                self._visit(child, active[go])

    def _compare(self, leaf: Tree, active: np.ndarray) -> None:
        for at in range(0, len(leaf.rows), 8 * LEAF):  # a leaf of equal vectors may be large
            rows = leaf.rows[at : at + 8 * LEAF]
            if not len(active):
                return
            likely = self.q_unit[active] @ self.unit[rows].T >= np.maximum(1 - (self.tau[active] + SLACK) ** 2 / 2, -2)[:, None]
            likely &= self.own[active][:, None] != self.ids[rows]
            q, m = np.nonzero(likely)
            if not len(q):
                continue
            q, m = active[q], rows[m]
            score = (self.q[q] * self.x[m]).sum(1) / (self.q_norm[q] * self.norm[m])
            some = np.unique(q)
            old = np.repeat(some, self.k)
            query = np.concatenate([old, q])
            member = np.concatenate([self.found[some].ravel(), m])
            value = np.concatenate([self.score[some].ravel(), score])
            order = np.lexsort((np.where(member < 0, np.iinfo(np.int64).max, self.ids[member]), -value, query))
            query, member, value = query[order], member[order], value[order]
            first = np.searchsorted(query, some)
            pick = first[:, None] + np.arange(self.k)  # every query has k entries at least
            self.found[some], self.score[some] = member[pick], value[pick]
            last = self.score[some, -1]
            full = np.isfinite(last)
            self.tau[some[full]] = np.minimum(self.tau[some[full]], np.sqrt(np.maximum(2 - 2 * last[full], 0)))


def _unit(x: np.ndarray) -> np.ndarray:
    own = scaled(x)
    return own / norms(own)[:, None]


def _layout(rows: DataFrame) -> Layout:
    """Cells of each sampled length, fitted on about SAMPLE rows; vectors of lengths that the sample lacks have one cell a length."""
    total = rows.count()
    share = min(2**30, 2**30 * SAMPLE // max(1, total) + 1)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(2**30)) < share).limit(2 * SAMPLE).orderBy("vec_id", "embedding").collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["embedding"]), []).append(r["embedding"])
    cells = {}
    for n, own in by_size.items():
        wanted = total * len(own) / len(sample) / CELL
        levels = int(np.clip(np.ceil(np.log2(max(wanted, 1))), 0, LEVELS))
        while levels and 2**levels * 4 > len(own):
            levels -= 1
        cells[n] = Cells(_unit(np.array(own)), levels)
    return Layout(cells)


def _measured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout: Layout = shared.value
        for batch in batches:
            for _, x in M.by_length(batch):
                size = x.shape[1]
                cell, d = layout.placed(_unit(x))
                out = []
                for c, n in zip(*np.unique(cell, return_counts=True)):
                    out.append((size, int(c), -1, int(n), 0.0, 0.0))
                    if d is not None:
                        own = d[cell == c][:, layout.cells[size].above[c]]
                        out += [(size, int(c), k, 0, float(a), float(b)) for k, (a, b) in enumerate(zip(own.min(0), own.max(0)))]
                kinds = (*[pa.int32()] * 3, pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*out), kinds)], names=["size", "cell", "level", "n", "low", "high"])

    return run


def _dealt(shared, k_home: bool, factor: float, members: bool):
    """Members of shards, or the queries that look into them: into their own cell, or into all others that they must reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout: Layout = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tau = None if members else batch.column(2).to_numpy(zero_copy_only=False)
            for at, x in M.by_length(batch):
                size, twin = x.shape[1], M.twins(x)
                cell, d = layout.placed(_unit(x))
                key = T.mixed(ids[at].view(np.uint64))
                x = scaled(x)
                where: list[tuple] = []
                if members:
                    for i, (c, h) in enumerate(zip(cell.tolist(), key.tolist())):
                        sub = h % layout.shards(size, c)
                        where += [(size, c, sub, s, i) for s in range(layout.salts(size, c)) if k_home or layout.looking.get((size, c))]
                else:
                    own = np.zeros((len(at), max(1, 2 ** layout.cells[size].levels) if d is not None else 1), bool)
                    own[np.arange(len(at)), cell] = True
                    reached = own if k_home else layout.reached(size, d, tau[at], factor) & ~own
                    for i, c in zip(*(v.tolist() for v in np.nonzero(reached))):
                        salt = (int(key[i]) >> 32) % layout.salts(size, c)
                        where += [(size, c, sub, salt, i) for sub in range(layout.shards(size, c))]
                for first in range(0, len(where), 4096):
                    size_, c, sub, salt, i = (np.array(v) for v in zip(*where[first : first + 4096]))
                    vectors = x[i]
                    width = 8 * x.shape[1]
                    raw = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(np.arange(0, (len(i) + 1) * width, width, dtype=np.int32)), pa.py_buffer(vectors.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(v, pa.int32()) for v in (size_, c, sub, salt)), pa.array(np.full(len(i), 0 if members else 1), pa.int32()), pa.array(ids[at][i]), pa.array(twin[i]), raw,
                         pa.nulls(len(i), pa.float64()) if members else pa.array(tau[at][i], pa.float64())],
                        names=[v.split()[0] for v in _SENT.split(", ")],
                    )

    return run


def _searched(k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, search = None, None
        for now, members, looking in M.meetings(batches, 4, BLOCK):
            size = now[0]
            if now != key:
                table = members.combine_chunks()
                ids, twin = (table.column(n).to_numpy() for n in ("vec_id", "twin"))
                x = M.matrix(table.column("vector").combine_chunks(), size)
                rows = M.distinct_rows(ids, twin)
                unit = x[rows] / norms(x[rows])[:, None]
                key, search = now, Search(ids[rows], x[rows], Tree(unit), unit, k, factor)
            looking = looking.combine_chunks()
            ids, twin, tau = (looking.column(n).to_numpy() for n in ("vec_id", "twin", "tau"))
            rows = M.distinct_rows(ids, twin)
            q, m, score = search.run(ids[rows], M.matrix(looking.column("vector").combine_chunks(), size)[rows], tau[rows])
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows][q]), pa.array(twin[rows][q]), pa.array(search.ids[m]), pa.array(score)], names=["query_id", "twin", "vec_id", "score"])

    return run


def nearest(df: DataFrame, every: int = EVERY, k: int = NEIGHBOURS, factor: float = FACTOR) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows found for each row whose vec_id is divisible by ``every``.

    Nearest by cosine, ties to the smaller vec_id. Vectors that are null, empty, zero or hold null or non-finite components
    take no part; vectors of different lengths never meet. Rows of the query's own vec_id are no candidates; repeated rows of
    one vec_id and vector are one row; different vectors of one vec_id are rows, and queries, of their own. A null id is a
    candidate, the smallest in ties. An empty table gives an empty one; other columns are left behind.
    """
    spark = df.sparkSession
    rows = M.usable(df).where(F.exists("embedding", lambda x: x != 0))
    layout = _layout(rows)
    first = spark.sparkContext.broadcast(layout)
    known = rows.mapInArrow(_measured(first), "size int, cell int, level int, n long, low double, high double")
    for r in known.groupBy("size", "cell", "level").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect():  # cells times levels
        if r["level"] < 0:
            layout.members[r["size"], r["cell"]] = r["n"]
        else:
            layout.low[r["size"]][r["cell"], r["level"]], layout.high[r["size"]][r["cell"], r["level"]] = r["low"], r["high"]
    queries = rows.where(F.col("vec_id") % every == 0)
    found_at_home = _round(rows, queries.withColumn("tau", F.lit(float("inf"))), layout, True, k, factor)
    home = T.checkpointed(_best(found_at_home, k))
    bound = home.where(F.col("rank") == k).select("query_id", "twin", F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0))).alias("tau"))
    # A query's bound belongs to its id; of several vectors of one id the widest holds for all.
    bound = bound.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("tau").alias("tau"), F.count("*").alias("n"))
    asked = home.where(F.col("rank") == 1).groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("all"))
    bound = T.checkpointed(bound.join(asked, "vec_id").where("n = all").select("vec_id", "tau"))
    wider = queries.join(bound, "vec_id", "left").withColumn("tau", F.coalesce("tau", F.lit(float("inf"))))
    away = T.checkpointed(_round(rows, wider, layout, False, k, factor))
    both = home.select("query_id", "twin", "vec_id", "score").union(away)
    return _best(both, k).select("query_id", "rank", T.public_id("vec_id"), "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _round(rows: DataFrame, queries: DataFrame, layout: Layout, home: bool, k: int, factor: float) -> DataFrame:
    """query_id, twin, vec_id and score of what queries (with tau, the distance within which they look) find in one round."""
    spark = rows.sparkSession
    layout.looking = {}
    plan = spark.sparkContext.broadcast(layout)
    asked = queries.select("vec_id", "embedding", "tau")
    counted = asked.mapInArrow(_dealt(plan, home, factor, False), _SENT).where("sub = 0").groupBy("size", "cell").count()
    layout.looking = {(r["size"], r["cell"]): r["count"] for r in counted.collect()}  # a row a cell
    plan = spark.sparkContext.broadcast(layout)
    looking = asked.mapInArrow(_dealt(plan, home, factor, False), _SENT)
    members = rows.select("vec_id", "embedding").mapInArrow(_dealt(plan, home, factor, True), _SENT)
    keys = ("size", "cell", "sub", "salt")
    sent = members.union(looking).repartition(T.partitions(spark), *keys).sortWithinPartitions(*keys, "looks")
    return sent.mapInArrow(_searched(k, factor), "query_id long, twin long, vec_id long, score double")
