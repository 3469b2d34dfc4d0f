"""Histogram sort into shards of equal bytes.

Rows are ordered by (xxhash64(text), doc_id). Splitters are found by counting the exact bytes below candidate key
boundaries over all partitions, again and again with finer probes around each target, until each splitter is within its
tolerance. Only then do the rows move, once. Equal texts are neighbours in key order and share a shard unless a splitter
falls among them and no boundary beside the group is within the tolerance: then the group is cut between two doc_ids,
so a group of any size never unbalances the shards.

Edge cases: a null text has size 1 and one key of its own; a null doc_id sorts first; rows equal in text and doc_id
stay together; an empty table gives an empty result; other columns are carried through untouched. Working columns
start with ``_hs_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenweb.llm.common import MAX_LONG, MIN_LONG, materialize, shuffle_partitions

#: Probes for each open splitter and round.
PROBES = 48
#: An interval of so few rows is settled by looking at its keys.
FEW_ROWS = 64


def _key_columns(text_col: str, id_col: str) -> list:
    return [F.xxhash64(F.col(text_col)).alias("_hs_k1"), F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_LONG)).alias("_hs_k2"), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1).alias("_hs_size")]


def bucket_of(k1: np.ndarray, k2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """For each key the number of boundaries (sorted pairs b1, b2) that are not above it."""
    left, right = np.searchsorted(b1, k1, "left"), np.searchsorted(b1, k1, "right")
    out = left.astype(np.int64)
    for value in np.unique(k1[left != right]):
        rows = k1 == value
        i, j = np.searchsorted(b1, value, "left"), np.searchsorted(b1, value, "right")
        out[rows] = i + np.searchsorted(b2[i:j], k2[rows], "right")
    return out


def _histogram(keys: DataFrame, asks: list[tuple[int | None, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Exact (bytes, rows) below each probe. An ask is (None, probes of k1) or (a value of k1, probes of k2 within it)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(p) + 1), np.int64) for _, p in asks]
        for batch in batches:
            k1, k2, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for (prefix, probes), total in zip(asks, sums, strict=True):
                if prefix is None:
                    at, own = np.searchsorted(probes, k1, "right"), size
                else:
                    rows = k1 == prefix
                    at, own = np.searchsorted(probes, k2[rows], "right"), size[rows]
                total[0] += np.bincount(at, weights=own, minlength=len(probes) + 1).astype(np.int64)
                total[1] += np.bincount(at, minlength=len(probes) + 1)
        for n, total in enumerate(sums):
            at = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_pydict({"ask": pa.array(np.full(len(at), n), pa.int32()), "at": pa.array(at, pa.int32()), "bytes": pa.array(total[0][at], pa.int64()), "rows": pa.array(total[1][at], pa.int64())})

    found = keys.mapInArrow(count, "ask int, at int, bytes long, rows long").groupBy("ask", "at").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    cells = [np.zeros((2, len(p) + 1), np.int64) for _, p in asks]
    for r in found:
        cells[r["ask"]][:, r["at"]] = r["bytes"], r["rows"]
    return [(np.cumsum(c[0])[:-1], np.cumsum(c[1])[:-1]) for c in cells]


class _Splitter:
    """One boundary to be found: target bytes below it, and the interval [lo, hi] of keys that holds it."""

    def __init__(self, target: float, tolerance: float, total: int, rows: int):
        self.target, self.tolerance, self.prefix = target, tolerance, None
        self.lo, self.lo_at = MIN_LONG, (0, 0)
        self.hi, self.hi_at = MAX_LONG, (total, rows)
        self.found: tuple[int, int] | None = None

    def _take(self, key: int) -> None:
        self.found = (key, MIN_LONG) if self.prefix is None else (self.prefix, key)

    def probes(self) -> np.ndarray:
        lo, span = self.lo, self.hi - self.lo
        return np.array(sorted({lo + span * i // (PROBES + 1) for i in range(1, PROBES + 1)} | {self.lo, self.hi}), dtype=np.int64)

    def narrow(self, probes: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
        i = int(np.searchsorted(sizes, self.target, "right"))
        if i and (probes[i - 1] > self.lo or self.lo_at == (0, 0)):
            self.lo, self.lo_at = int(probes[i - 1]), (int(sizes[i - 1]), int(rows[i - 1]))
        if i < len(probes) and probes[i] <= self.hi:
            self.hi, self.hi_at = int(probes[i]), (int(sizes[i]), int(rows[i]))
        self.settle()

    def settle(self) -> None:
        away = [(abs(at[0] - self.target), key) for key, at in ((self.lo, self.lo_at), (self.hi, self.hi_at))]
        if min(away)[0] <= self.tolerance:
            self._take(min(away)[1])
        elif self.hi - self.lo <= 1 and self.prefix is None and self.hi_at[1] - self.lo_at[1] > FEW_ROWS:
            # One hash holds the target: go on among the ids of that group.
            self.prefix = self.lo
            self.base = self.lo_at
            self.end = self.hi_at
            self.lo, self.hi = MIN_LONG, MAX_LONG
        elif self.hi - self.lo <= 1 and self.prefix is not None:
            self._take(min(away)[1])

    def few(self) -> bool:
        return self.found is None and self.hi_at[1] - self.lo_at[1] <= FEW_ROWS

    def pick(self, rows: list[tuple[int, int, int]]) -> None:
        """rows: all (k1, k2, size) of the interval."""
        below, best, last = self.lo_at[0], [], None
        for k1, k2, size in sorted(rows) + [(None, None, 0)]:
            if k1 is None or last is None or (k1, k2) != last:
                key = (k1, MIN_LONG if last is None or k1 != last[0] else k2) if k1 is not None else ((self.hi, MIN_LONG) if self.prefix is None else (self.prefix, self.hi))
                inside = last is not None and k1 == last[0] and self.prefix is None
                best.append((inside or abs(below - self.target) > self.tolerance, abs(below - self.target), key))
            below += size
            last = (k1, k2)
        self.found = min(best, key=lambda x: (x[0], x[1]))[2]


def find_splitters(keys: DataFrame, n: int, every: int, tolerance: float) -> list[tuple[int, int]]:
    """n - 1 boundaries that cut the keys in n runs of equal bytes; each every-th one to the tolerance (a share of a shard), the others to a tenth of a run."""
    total, rows = keys.agg(F.coalesce(F.sum("_hs_size"), F.lit(0)), F.count("*")).first()
    fine, coarse = tolerance * total / max(1, n // every), 0.1 * total / n
    splitters = [_Splitter(total * i / n, fine if i % every == 0 else coarse, total, rows) for i in range(1, n)]
    for s in splitters:
        s.settle()
    while open_ := [s for s in splitters if s.found is None]:
        if few := [s for s in open_ if s.few()]:
            _settle_few(keys, few)
            continue
        asks: dict[int | None, list[np.ndarray]] = {}
        for s in open_:
            asks.setdefault(s.prefix, []).append(s.probes())
        merged = [(prefix, np.unique(np.concatenate(p))) for prefix, p in asks.items()]
        for (prefix, probes), (sizes, counts) in zip(merged, _histogram(keys, merged), strict=True):
            for s in open_:
                if s.prefix == prefix and s.found is None:
                    base = (0, 0) if prefix is None else s.base
                    s.narrow(probes, sizes + base[0], counts + base[1])
    return [s.found for s in splitters]


def _inside(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether each key is in one of the intervals [lo, hi): more of them begin than end up to it."""
    return np.searchsorted(np.sort(lo), keys, "right") > np.searchsorted(np.sort(hi), keys, "right")


def _settle_few(keys: DataFrame, few: list[_Splitter]) -> None:
    """Intervals of at most FEW_ROWS rows each: fetch their keys, at most FEW_ROWS times the number of splitters."""
    level = {False: [s for s in few if s.prefix is None], True: [s for s in few if s.prefix is not None]}
    lo = {k: np.array([s.lo for s in v], np.int64) for k, v in level.items()}
    hi = {k: np.array([s.hi for s in v], np.int64) for k, v in level.items()}
    prefix = np.array([s.prefix for s in level[True]], np.int64)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            keep = _inside(k1, lo[False], hi[False])
            group = np.flatnonzero(np.isin(k1, prefix))
            for p in np.unique(k1[group]):
                rows = group[k1[group] == p]
                keep[rows] |= _inside(k2[rows], lo[True][prefix == p], hi[True][prefix == p])
            yield pa.RecordBatch.from_pydict({"k1": pa.array(k1[keep], pa.int64()), "k2": pa.array(k2[keep], pa.int64()), "size": pa.array(size[keep], pa.int64())})

    rows = [tuple(r) for r in keys.mapInArrow(fetch, "k1 long, k2 long, size long").collect()]
    for s in few:
        s.pick([r for r in rows if (s.lo <= r[0] < s.hi if s.prefix is None else r[0] == s.prefix and s.lo <= r[1] < s.hi)])


def shard(df: DataFrame, n_shards: int = 16, text_col: str = "text", id_col: str = "doc_id", tolerance: float = 0.002) -> DataFrame:
    """df with ``shard`` (0 to n_shards - 1, equal bytes) and ``slot`` (gapless from 0 in each shard, in key order).

    tolerance: how far a splitter may lie from its ideal place, as a share of a shard's bytes, so long as that keeps
    equal texts together; else it lies at the nearest row.
    """
    spark = df.sparkSession
    keys = materialize(df.select(*_key_columns(text_col, id_col)), "shard-keys")
    runs = max(1, -(-4 * shuffle_partitions(spark) // n_shards))
    bounds = find_splitters(keys, n_shards * runs, runs, tolerance)
    bounds = sorted(bounds)
    b1, b2 = (np.array([b[i] for b in bounds], np.int64) for i in range(2))

    @F.pandas_udf("int")
    def bucket(k1: pd.Series, k2: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(k1.to_numpy(), k2.to_numpy(), b1, b2))

    counts = dict(keys.groupBy(bucket("_hs_k1", "_hs_k2").alias("b")).count().collect())
    first, base = 0, []
    for b in range(n_shards * runs):
        first = 0 if b % runs == 0 else first
        base.append(first)
        first += counts.get(b, 0)
    h1, h2, _ = _key_columns(text_col, id_col)
    dealt = df.withColumns({"_hs_k1": h1, "_hs_k2": h2}).withColumn("_hs_b", bucket("_hs_k1", "_hs_k2")).repartition(shuffle_partitions(spark), "_hs_b")
    place = F.row_number().over(Window.partitionBy("_hs_b").orderBy("_hs_k1", "_hs_k2")) - 1
    bases = np.array(base, np.int64)

    @F.pandas_udf("long")
    def offset(b: pd.Series) -> pd.Series:
        return pd.Series(bases[b.to_numpy()])

    return dealt.withColumn("_hs_place", place.cast("long")).withColumn("slot", offset("_hs_b") + F.col("_hs_place")).drop("_hs_place").withColumn("shard", F.floor(F.col("_hs_b") / runs).cast("int")).drop("_hs_k1", "_hs_k2", "_hs_b")


def shard_digests(df: DataFrame, n_shards: int = 16) -> DataFrame:
    """The query's columns, derived from the sharded texts."""
    out = shard(df, n_shards)
    return out.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"), F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
