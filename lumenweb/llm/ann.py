"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Largest inner product becomes smallest distance: a candidate x gets the extra coordinate sqrt(M^2 - |x|^2), M the largest
norm, and a query gets 0 there. All are projected by a Gaussian (2-stable) matrix to ``DIMS`` dimensions, where a squared
projected distance over the true one is chi-square with DIMS degrees of freedom. The top of the kd-tree over the
projections is common to all: its cuts are medians of a bounded sample (``SAMPLE`` rows, those with the smallest hashes),
its cells hold all rows, with their exact boxes, and a cell is as many shards as its rows need, so that copies of one
vector are no hot task. Each shard goes on with a kd-tree of its own.

A query is first searched in its own cell. Then it goes to those cells only that are so near that a row nearer than the
k-th found could be there: at a larger distance a nearer row would be projected that far with a probability below
1 - ``CONFIDENCE``. In a shard it takes the leaves in the order of their projected distance and verifies their rows by the
true inner product, until the same test stops it. The queries of a block take their next leaves together, so that a leaf
is verified for all queries that want it by one matrix product. What the shards found is merged exactly.

Every row is indexed; of equal vectors in a shard the 2 k rows with the smallest ids, at most k of them of one id, stand
for all, since no other of them can be among k neighbours. Where there are few shards, each one is searched by several
tasks that share the queries.

Edge cases: null or zero vectors, those with null or non-finite components and those of another length than most rows
have (the shorter at a tie) take no part; equal scores go by the smaller id; fewer candidates than k: all of them;
repeated ids are candidates each (a row each in the result), ask once (with the smallest vector), and none of them is a neighbour of its own id; rows with a null id take no part; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenweb.llm.common import even_keys, materialize

#: SHARD_VALUES: components of the vectors of one shard. BLOCK: queries that are searched together. SAMPLE: rows whose medians cut the cells.
DIMS, CONFIDENCE, LEAF, SHARD_VALUES, BLOCK, SAMPLE, SEED = 8, 0.95, 256, 2_000_000, 512, 20_000, 42
#: Scores that are so near to the k-th are computed again row by row, so that equal vectors have equal scores.
CLOSE = 1e-9
EVEN_SLOTS = 1024


def chi_square_cdf(x: np.ndarray, dims: int) -> np.ndarray:
    """For an even number of degrees of freedom."""
    h = np.asarray(x, np.float64) / 2
    term, total = np.ones_like(h), np.ones_like(h)
    for i in range(1, dims // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-np.minimum(h, 700)) * total


def chi_square_quantile(p: float, dims: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, dims) < p else (lo, mid)
    return hi


class KDTree:
    """Median splits on the widest side; leaves in arrays, with their boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))] if len(points) else []
        while stack:
            at = stack.pop()
            own = points[at]
            spread = own.max(0) - own.min(0)
            if len(at) <= LEAF or not spread.max() > 0:
                self.leaves.extend(at[i : i + LEAF] for i in range(0, len(at), LEAF))
                continue
            order = np.argpartition(own[:, spread.argmax()], len(at) // 2)
            stack += [at[order[len(at) // 2 :]], at[order[: len(at) // 2]]]
        self.low = np.array([points[x].min(0) for x in self.leaves])
        self.high = np.array([points[x].max(0) for x in self.leaves])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the leaves' boxes."""
        out = np.zeros((len(q), len(self.leaves)))
        for i in range(q.shape[1]):
            off = np.maximum(np.maximum(self.low[:, i] - q[:, i, None], q[:, i, None] - self.high[:, i]), 0)
            out += off * off
        return out


def _order_in(groups: np.ndarray) -> np.ndarray:
    """For sorted groups each row's number in its group."""
    n = np.arange(len(groups))
    new = np.concatenate(([True], groups[1:] != groups[:-1]))
    return n - np.maximum.accumulate(np.where(new, n, 0))


def _first_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows of each vector that can be among k neighbours of a query: k of an id are enough, and without the query's own id k are left of 2 k."""
    if not len(ids):
        return np.zeros(0, np.int64)
    same = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * vectors.itemsize))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((ids, same))
    own = np.cumsum(np.concatenate(([True], (same[order][1:] != same[order][:-1]) | (ids[order][1:] != ids[order][:-1]))))
    order = order[_order_in(own) < k]
    return np.sort(order[_order_in(same[order]) < 2 * k])


class Cells:
    """The top of the kd-tree: cuts at medians of a sample's projections, and exact boxes of the cells."""

    def __init__(self, sample: np.ndarray, n: int, dims: int = DIMS):
        #: (axis, cut, child below the cut, child above); a cell is (-1, 0, its number, 0).
        self.nodes: list[tuple[int, float, int, int]] = [(-1, 0.0, 0, 0)]
        self.n, self.dims = 1, dims
        todo = [(len(sample), 0, np.arange(len(sample)))]
        while self.n < n and todo:
            todo.sort(key=lambda x: (x[0], -x[1]))
            _, node, at = todo.pop()
            own = sample[at]
            if len(at) < 2 or not (own.max(0) > own.min(0)).any():
                continue
            axis = int((own.max(0) - own.min(0)).argmax())
            cut = float(np.median(own[:, axis]))
            below = own[:, axis] < cut
            if not below.any():
                cut = float(own[own[:, axis] > cut, axis].min())
                below = own[:, axis] < cut
            cell = self.nodes[node][2]
            self.nodes += [(-1, 0.0, cell, 0), (-1, 0.0, self.n, 0)]
            self.nodes[node] = axis, cut, len(self.nodes) - 2, len(self.nodes) - 1
            self.n += 1
            todo += [(len(x), child, x) for child, x in zip(self.nodes[node][2:], (at[below], at[~below]), strict=True)]
        self.box(np.full((self.n, dims), -np.inf), np.full((self.n, dims), np.inf))

    def box(self, low: np.ndarray, high: np.ndarray) -> None:
        """The cells' boxes; an empty cell's is reached from nowhere."""
        self.low, self.high = np.full((len(self.nodes), self.dims), np.inf), np.full((len(self.nodes), self.dims), -np.inf)
        for i in reversed(range(len(self.nodes))):
            axis, _, a, b = self.nodes[i]
            self.low[i], self.high[i] = (low[a], high[a]) if axis < 0 else (np.minimum(self.low[a], self.low[b]), np.maximum(self.high[a], self.high[b]))

    def place(self, points: np.ndarray) -> np.ndarray:
        out, stack = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while stack:
            i, at = stack.pop()
            axis, cut, a, b = self.nodes[i]
            if axis < 0:
                out[at] = a
            elif len(at):
                below = points[at, axis] < cut
                stack += [(a, at[below]), (b, at[~below])]
        return out

    def reach(self, points: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) of the cells whose squared distance is at most the point's bound."""
        found, stack = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], [(0, np.arange(len(points)))]
        while stack:
            i, at = stack.pop()
            with np.errstate(invalid="ignore"):
                off = np.maximum(np.maximum(self.low[i] - points[at], points[at] - self.high[i]), 0)
                at = at[(off * off).sum(1) <= bound[at]]
            axis, _, a, b = self.nodes[i]
            if axis < 0:
                found.append((at, np.full(len(at), a)))
            elif len(at):
                stack += [(a, at), (b, at)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _matrix(dim: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim + 1, dims))


def _projected(vectors: np.ndarray, top: float | None) -> np.ndarray:
    """Candidates' projections; top None: queries'."""
    last = np.zeros(len(vectors)) if top is None else np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.column_stack((vectors, last)) @ _matrix(vectors.shape[1])


class Shard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float, k: int):
        kept = _first_copies(ids, vectors, k)
        self.ids, self.vectors, self.top, self.k = ids[kept], vectors[kept], top, k
        self.tree = KDTree(_projected(self.vectors, top))
        self.verified = 0
        #: Stop at projected distance^2 >= quantile * distance^2 of the k-th.
        self.quantile = chi_square_quantile(CONFIDENCE, DIMS)

    def search(self, own: np.ndarray, q: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of the k best of each query; known: the k-th score found elsewhere, below which nothing is asked for."""
        k, n = self.k, len(own)
        if not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        far = self.tree.distances(_projected(q, None))
        by = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, by, 1)
        base = np.einsum("ij,ij->i", q, q) + self.top * self.top
        at, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        worst = np.full(n, -np.inf) if known is None else known.copy()
        active = np.flatnonzero(~(far[:, 0] > self.quantile * np.maximum(0.0, base - 2 * worst) + CLOSE))
        for turn in range(by.shape[1]):
            if not len(active):
                break
            leaf = by[active, turn]
            order = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.diff(leaf[order])) + 1
            new_at, new_rows = [], []
            for part in np.split(order, cuts):
                rows, who = self.tree.leaves[leaf[part[0]]], active[part]
                self.verified += len(rows) * len(who)
                x, y = np.nonzero(q[who] @ self.vectors[rows].T >= (worst[who] - CLOSE)[:, None])
                new_at.append(who[x])
                new_rows.append(rows[y])
            a, r = np.concatenate(new_at), np.concatenate(new_rows)
            other = self.ids[r] != own[a]
            a, r = a[other], r[other]
            at, ids, scores = np.concatenate((at, a)), np.concatenate((ids, self.ids[r])), np.concatenate((scores, np.einsum("ij,ij->i", self.vectors[r], q[a])))
            best = np.lexsort((ids, -scores, at))
            at, ids, scores = at[best], ids[best], scores[best]
            first = np.searchsorted(at, np.arange(n))
            rank = np.arange(len(at)) - first[at]
            last = rank == k - 1
            worst[at[last]] = np.maximum(worst[at[last]], scores[last])
            keep = rank < k
            at, ids, scores = at[keep], ids[keep], scores[keep]
            if turn + 1 < by.shape[1]:
                nearest = np.maximum(0.0, base[active] - 2 * worst[active])
                active = active[~(far[active, turn + 1] > self.quantile * nearest + CLOSE)]
        return at, ids, scores


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(ok).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _cells(rows: DataFrame, dim: int, n: int, top: float) -> tuple[Cells, np.ndarray]:
    """The cells, and the number of shards of each. What comes to the driver is the sample's projections and the cells' boxes."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _projected(_vectors(batch.column(1), dim), top)
            yield pa.RecordBatch.from_arrays([pa.array(p.tolist(), pa.list_(pa.float64()))], ["p"])

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _projected(_vectors(batch.column(1), dim), top)
            cell = cells.place(p)
            order = np.argsort(cell, kind="stable")
            begins = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) != 0)))[: len(cell)]
            low, high = (f.reduceat(p[order], begins) if len(cell) else np.zeros((0, DIMS)) for f in (np.minimum, np.maximum))
            size = np.diff(np.append(begins, len(cell)))
            of = np.repeat(cell[order][begins], DIMS)
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.tile(np.arange(DIMS), len(begins))), pa.array(np.repeat(size, DIMS)), pa.array(low.ravel()), pa.array(high.ravel())], ["cell", "axis", "n", "low", "high"])

    wanted = max(1, -(-n * dim // SHARD_VALUES))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).mapInArrow(project, "p array<double>").collect() if wanted > 1 else []
    cells = Cells(np.array([r["p"] for r in sample], np.float64).reshape(-1, DIMS), wanted)
    if cells.n == 1:
        return cells, np.array([wanted])
    got = rows.mapInArrow(boxes, "cell long, axis long, n long, low double, high double").groupBy("cell", "axis").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    low, high, size = np.full((cells.n, DIMS), np.inf), np.full((cells.n, DIMS), -np.inf), np.ones(cells.n, np.int64)
    for r in got:
        low[r["cell"], r["axis"]], high[r["cell"], r["axis"]], size[r["cell"]] = r["low"], r["high"], r["n"]
    cells.box(low, high)
    return cells, -(-size * dim // SHARD_VALUES)


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); queries are the rows whose id is divisible by every."""
    spark = df.sparkSession
    rows = _valid(df, id_col, vec_col)
    usual = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("s")).orderBy(F.desc("c"), "n").first()
    dim, n, top = (usual["n"], usual["c"], float(np.sqrt(usual["s"]))) if usual else (1, 0, 0.0)
    rows = rows.where(F.size("v") == dim)
    cells, slices = _cells(rows, dim, n, top)
    first = np.cumsum(slices) - slices
    shards = int(slices.sum())
    groups = max(1, -(-spark.sparkContext.defaultParallelism // shards))
    # A partition for each slot; where there are many, chance deals them well enough.
    keys = even_keys(1, shards * groups) if shards * groups <= EVEN_SLOTS else np.arange(shards * groups, dtype=np.int32)
    quantile = chi_square_quantile(CONFIDENCE, DIMS)
    schema = "id long, v array<double>, known double, kind int, slot int"

    def dealt(column: list[pa.Array], at: np.ndarray, known: np.ndarray, kind: int, shard: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
        slot = keys[shard * groups + group]
        return pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in column[:2]), pa.array(known), pa.array(np.full(len(at), kind, np.int32)), pa.array(slot, pa.int32())], ["id", "v", "known", "kind", "slot"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row to its shard, in every group."""
        for batch in batches:
            cell = cells.place(_projected(_vectors(batch.column(1), dim), top))
            own = first[cell] + batch.column(2).to_numpy(zero_copy_only=False) % slices[cell]
            for g in range(groups):
                yield dealt(batch.columns, np.arange(len(own)), np.full(len(own), -np.inf), 0, own, np.full(len(own), g))

    def ask(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each query to the shards of its own cell, or of the others that it may have to see."""
            for batch in batches:
                q = _vectors(batch.column(1), dim)
                p, known = _projected(q, None), batch.column(3).to_numpy(zero_copy_only=False)
                own = cells.place(p)
                at, cell = np.arange(len(q)), own
                if not home:
                    at, cell = cells.reach(p, quantile * np.maximum(0.0, np.einsum("ij,ij->i", q, q) + top * top - 2 * known) + CLOSE)
                    at, cell = at[cell != own[at]], cell[cell != own[at]]
                group = batch.column(2).to_numpy(zero_copy_only=False) % groups
                times = slices[cell]
                shard = np.repeat(first[cell], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                at = np.repeat(at, times)
                yield dealt(batch.columns, at, known[at], 1, shard, group[at])

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, index_ = None, [], None
        for batch in batches:
            ids, known, kinds, slots = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            vectors = _vectors(batch.column(1), dim)
            cuts = [0, *(np.flatnonzero((np.diff(slots) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if slots[a] != now:
                    now, own, index_ = slots[a], [], None
                if kinds[a] == 0:
                    own.append((ids[a:b].copy(), vectors[a:b].copy()))
                    continue
                if index_ is None:
                    index_ = Shard(np.concatenate([np.zeros(0, np.int64), *(x for x, _ in own)]), np.concatenate([np.zeros((0, dim)), *(x for _, x in own)]), top, k)
                    own = []
                for i in range(a, b, BLOCK):
                    j = min(b, i + BLOCK)
                    at, near, scores = index_.search(ids[i:j], vectors[i:j], known[i:j])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][at]), pa.array(near), pa.array(scores)], ["query_id", "vec_id", "score"])

    kept = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(2**31 - 1)).alias("h")).mapInArrow(index, schema)
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))

    def searched(asked: DataFrame, home: bool) -> DataFrame:
        asked = asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(2**31 - 1)).alias("h"), "known").mapInArrow(ask(home), schema)
        both = kept.union(asked).repartition(shards * groups, "slot").sortWithinPartitions("slot", "kind")
        return both.mapInArrow(search, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = searched(queries.withColumn("known", F.lit(float("-inf"))), True)
    if cells.n > 1:
        found = materialize(best(found), "ann-home").drop("rank")
        kth = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select(F.col("query_id").alias("id"), "least")
        rest = queries.join(kth, "id", "left").select("id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("known"))
        found = found.union(searched(rest, False))
    return best(found)
