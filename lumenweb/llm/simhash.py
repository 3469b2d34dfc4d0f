"""SimHash near-duplicates: fingerprints of 4-word shingles, linked where at most 4 of 64 bits differ.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, each shingle's XXH64 (UTF-8, seed 42); a bit is 1 if it is
set in over half the hashes, repeats included. Fewer words than a shingle: the whole sequence; none: zero.

Links: distinct fingerprints only. Two that differ in at most r bits agree in at least b - r of b blocks, so each one is
dealt under every choice of b - r blocks (as many bits of it as make shards of ``MEAN`` fingerprints). Every shard, however
small, is a BK-tree (see bktree) that all its fingerprints search along the edges within the radius; nothing else compares
fingerprints. Links that a fingerprint meets on its way into the tree come first, and a search doesn't enter a subtree all
of which is in its own component already, so a large group of near copies costs no pairs. What leaves a shard is a star
for each component. An oversized shard is cut in slices, and each pair of slices meets in a task of its own. A tree and
the fingerprints that search it meet by the shuffle, not by a broadcast: all trees together are the fingerprints of all
documents, which never go to the driver. Components: large-star, small-star.

Edge cases: a null text has no words; null doc_ids never are a component's smallest (a component of only nulls has a
null id); repeated rows get a row each (``keep_one`` keeps one of them, of rows equal in id and text that with the smallest
hash of all columns); an empty table gives an empty result; other
columns are carried by ``keep_one``. Working columns start with ``_sh_``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.bktree import Forest, merge
from lumenweb.llm.common import MAX_LONG, materialize, shuffle_partitions
from lumenweb.llm.components import connected_components

#: Fingerprints of a shard, if they are unrelated; and how many it may be before more blocks are worth their copies.
MEAN, MOST = 64, 512
#: Fingerprints that search together before the components are taken anew, at first and at most.
FIRST, ROUND = 1024, 65_536
#: Share of the components that trees in another order must have joined to be worth growing again.
STILL = 0.05
#: A shard of more fingerprints is cut in slices of this many.
SLICE = 50_000
#: Rows that a table may have to be broadcast.
BROADCAST_ROWS = 100_000
_TOP = np.uint64(1) << np.uint64(63)


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n, of = len(words) - width + 1, xxhash.xxh64_intdigest
        hashes = np.fromiter((of(line[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 4, *carry: str) -> DataFrame:
    """(id, fp), fp the fingerprint as a long with the same bits; with a column to carry, also that as hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], ["id", "fp", "hash"][: batch.num_columns])

    asked = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), *(F.col(c).alias("hash") for c in carry))
    return asked.mapInArrow(run, "id long, fp long" + ", hash long" * len(carry))


def _masks(n: int, radius: int) -> list[np.uint64]:
    """One for each choice of blocks. Fewest blocks whose shards of n unrelated fingerprints stay under MOST, and no more bits than make them MEAN."""
    wanted = max(0, (n // MEAN).bit_length())
    for b in range(radius + 1, radius + 5):
        if n >> (64 * (b - radius) // b) <= MOST:
            break
    edges = [64 * i // b for i in range(b + 1)]
    out = set()
    for choice in combinations(range(b), b - radius):
        bits = [k for i in choice for k in range(edges[i], edges[i + 1])]
        out.add(sum(1 << k for k in bits[:wanted]))
    return [np.uint64(m) for m in sorted(out)]


def _met(forest: Forest, items: np.ndarray, tree: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels after the links that items meet on their way into their trees, and into trees grown in other orders for as long as that joins many."""
    labels = merge(labels, *forest.met)
    rng, n = np.random.default_rng(1), len(items)
    left, before = np.count_nonzero(labels[:n] == np.arange(n)), n
    while left < (1 - STILL) * before:
        order = rng.permutation(n)
        a, b = Forest(items[order], tree[order], forest.radius).met
        labels = merge(labels, order[a], order[b])
        left, before = np.count_nonzero(labels[:n] == np.arange(n)), left
    return labels


def shard_links(key: np.ndarray, fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """key: each row's shard. Side 0 rows make its tree; side 1 rows search it, or those of side 0 if it has no others (where there are two slices, each one's own links are another task's). Returns a star of each component of more than one."""
    place = np.argsort(side, kind="stable")
    f, k, n = fp[place], key[place], np.count_nonzero(side == 0)
    forest = Forest(f[:n], k[:n], radius)
    labels = _met(forest, f[:n], k[:n], np.arange(len(f)))
    asking = np.concatenate((np.flatnonzero(~np.isin(k[:n], k[n:])), np.arange(n, len(f))))
    # Those of small components first: what they join makes whole subtrees for the others.
    size = np.bincount(labels, minlength=len(f))[labels]
    asking = asking[np.argsort(size[asking], kind="stable")]
    at, step = 0, FIRST
    while at < len(asking):
        some = asking[at : at + step]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in forest.search(f[some], k[some], labels[some], forest.whole(labels[:n])):
            apart = labels[some[i]] != labels[j]
            x, y = some[i[apart]], j[apart]
            if len(x):  # one link of each two components
                _, first = np.unique(labels[x] * len(f) + labels[y], return_index=True)
                found.append((x[first], y[first]))
        labels = merge(labels, *(np.concatenate(x) for x in zip(*found, strict=True)))
        at, step = at + step, min(2 * step, ROUND)
    tied = np.flatnonzero(labels != np.arange(len(f)))
    return f[tied], f[labels[tied]]


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """fps: distinct (fp long). Returns (u, v), v < u: links that join the same components as all links would."""
    spark = fps.sparkSession
    n = fps.count()
    masks = _masks(n, radius)
    parts = max(shuffle_partitions(spark), len(masks) * n // 1_000_000 + 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for m, mask in enumerate(masks):
                # The choice goes into the key by a mixing step that is one to one for each choice.
                key = ((fp & mask) ^ np.uint64(m * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), m, np.int32)), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["m", "key", "fp"])

    dealt = fps.select("fp").mapInArrow(deal, "m int, key long, fp long")
    if n > SLICE:
        large = materialize(dealt.groupBy("m", "key").count().where(F.col("count") > SLICE).select("m", "key", F.ceil(F.col("count") / SLICE).cast("int").alias("slices")), "near-large")
        size = large.count()
    else:
        size = 0
    if size:
        other = F.broadcast(large) if size <= BROADCAST_ROWS else large
        cut = dealt.join(other, ["m", "key"], "left").withColumn("s", F.pmod(F.xxhash64("fp"), F.coalesce("slices", F.lit(1))).cast("int"))
        dealt = cut.withColumn("t", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).select("m", "key", "fp", F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"), (F.col("s") > F.col("t")).cast("int").alias("side"))
    else:
        dealt = dealt.select("m", "key", "fp", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        all_ = pa.Table.from_batches(kept)
        m, key, fp, a, b, side = (c.to_numpy() for c in all_.columns)
        mixed = key.view(np.uint64) ^ (m.astype(np.uint64) * np.uint64(0x94D049BB133111EB)) ^ ((a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93))
        x, y = (z.view(np.int64) for z in shard_links(mixed, fp.view(np.uint64), side, radius))
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["u", "v"])

    return dealt.repartition(parts, "key", "m", "a", "b").mapInArrow(run, "u long, v long")


def _placed(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of fps (id, fp)."""
    groups = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "near-groups")
    roots = connected_components(links(groups.select("fp"), radius))
    placed = groups.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "near-placed")
    least = materialize(placed.groupBy("root").agg(F.min("least").alias("component_id")), "near-least")
    return materialize(placed.join(least, "root").select("fp", "root", "component_id"), "near-named")


def components(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp long, component_id): component_id is the smallest id reachable over links."""
    fps = materialize(fingerprints(df, text_col, id_col, width), "near-fp")
    return fps.join(_placed(fps, radius).drop("root"), "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def near_duplicates(df: DataFrame) -> DataFrame:
    return components(df).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 4, radius: int = 4) -> DataFrame:
    """df with one row of each component: that of the smallest id (null last), and of the smallest text hash at a tie."""
    key = {"_sh_id": F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)), "_sh_hash": F.coalesce(F.xxhash64(text_col), F.lit(0))}
    named = df.withColumns(key)
    fps = materialize(fingerprints(named, text_col, "_sh_id", width, "_sh_hash"), "near-fp")
    rooted = fps.join(_placed(fps, radius).drop("component_id"), "fp").select("id", "hash", "root")
    first = materialize(rooted.groupBy("root").agg(F.min(F.struct("id", "hash")).alias("k"), F.count("*").alias("n")).where("n > 1"), "near-first")
    rooted = rooted.join(first, "root")
    gone = materialize(rooted.where((F.col("id") != F.col("k.id")) | (F.col("hash") != F.col("k.hash"))).select(F.col("id").alias("_sh_id"), F.col("hash").alias("_sh_hash")).distinct(), "near-gone")
    kept = named.join(gone, ["_sh_id", "_sh_hash"], "left_anti")
    if fps.groupBy("id", "hash").count().where("count > 1").limit(1).count():  # repeated rows
        kept = kept.withColumn("_sh_all", F.xxhash64(*[F.to_json(F.struct(*df.columns))]))
        least = kept.groupBy("_sh_id", "_sh_hash").agg(F.min("_sh_all").alias("_sh_all"))
        kept = kept.join(least, ["_sh_id", "_sh_hash", "_sh_all"], "left_semi").dropDuplicates(["_sh_id", "_sh_hash", "_sh_all"])
    return kept.select(*df.columns)
