"""Best-fit packing of token sequences with large-item matching.

A document's ids are followed by one separator id; longer documents than a sequence are cut into full pieces, and what is
over comes first. Packing depends on the lengths alone, and there are at most ``capacity`` of them, so the plan is made
for the exact count of each length, on the driver, in memory that the capacity bounds: pieces above a third of the
capacity (of which a sequence holds two at most) are matched greedily, the longest with the longest that fits; then
smaller ones, longest first, go where they leave the least room. A plan is a list of patterns and how often each is used.
A piece finds its place by its rank among the pieces of its length; ranks are counted in chunks, so that a length that a
third of all pieces share is ranked by many tasks.

Edge cases: a null or empty text is the separator alone; rows with the same doc_id are packed each; a null doc_id is a
value like others; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenweb.llm.common import materialize, shuffle_partitions

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Texts with a run of so many characters without white space, or of it, go to the reference tokenizer: the fast one takes time in the square of a run's length.
LONG_RUN = 2000
_RUNS = re.compile(r"\S{2000,}|\s{2000,}")


@lru_cache(maxsize=2)
def _reference(json_path: str) -> Tokenizer:
    slow = Tokenizer.from_file(json_path)
    slow.no_truncation()
    slow.no_padding()
    return slow


@lru_cache(maxsize=2)
def _ranked(json_path: str, ranks_path: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path, "rb") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(text: str | None, json_path: str, ranks_path: str | None) -> np.ndarray:
    """The ids that the tokenizers library gives for json_path; ranks_path: the same vocabulary as ranks, which is faster."""
    text = text or ""
    # A run of white space counts as a run too.
    long_run = len(text) > LONG_RUN and max(map(len, _RUNS.findall(text)), default=0) > LONG_RUN
    if ranks_path is None or long_run:
        return np.array(_reference(json_path).encode(text, add_special_tokens=False).ids, np.uint32)
    return _ranked(json_path, ranks_path).encode_to_numpy(text, allowed_special="all").astype(np.uint32)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """counts: pieces by length. Returns patterns: (number of sequences, [(length, how many of it)])."""
    left = dict(counts)
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []
    large = sorted(s for s in left if 3 * s > capacity)
    for a in reversed(large):
        while left[a]:
            i = bisect.bisect_right(large, min(a, capacity - a)) - 1
            while i >= 0 and not left[large[i]] - (large[i] == a and left[a] < 2):
                i -= 1
            if i < 0:
                bins.append((left[a], capacity - a, [(a, 1)]))
                left[a] = 0
            elif (b := large[i]) == a:
                bins.append((left[a] // 2, capacity - 2 * a, [(a, 2)]))
                left[a] %= 2
            else:
                n = min(left[a], left[b])
                bins.append((n, capacity - a - b, [(a, 1), (b, 1)]))
                left[a] -= n
                left[b] -= n
    open_: dict[int, list] = {}
    gaps: list[int] = []

    def put(n: int, gap: int, items: list) -> None:
        if gap not in open_:
            open_[gap] = []
            bisect.insort(gaps, gap)
        open_[gap].append((n, items))

    for b in bins:
        put(*b)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        c = left[s]
        while c:
            i = bisect.bisect_left(gaps, s)
            if i == len(gaps):
                k = capacity // s
                if c >= k:
                    put(c // k, capacity - k * s, [(s, k)])
                if c % k:
                    put(1, capacity - c % k * s, [(s, c % k)])
                break
            gap = gaps[i]
            n, items = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(i)
            k = gap // s
            if full := min(n, c // k):
                put(full, gap - k * s, [*items, (s, k)])
                c -= full * k
                n -= full
            if c and n and c < k:
                put(1, gap - c * s, [*items, (s, c)])
                c, n = 0, n - 1
            if n:
                put(n, gap, items)
    return [x for gap in gaps for x in open_[gap]]


def _lookup(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the first rank of each run of places, and the sequence and offset where that run begins."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    base = 0
    for n, items in patterns:
        offset = 0
        for s, k in items:
            for _ in range(k):
                rows.setdefault(s, []).append((given.get(s, 0), base, offset))
                given[s] = given.get(s, 0) + n
                offset += s
        base += n
    return {s: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for s, r in rows.items()}


def pieces(df: DataFrame, capacity: int, json_path: str, ranks_path: str | None, text_col: str = "text", id_col: str = "doc_id", separator: int = 0, with_ids: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py(), json_path, ranks_path), np.uint32(separator)).astype("<u4")
                start, piece = 0, 0
                while start < len(ids):
                    length = (len(ids) - start) % capacity or capacity
                    own = ids[start : start + length]
                    out.append((doc, piece, start, length, zlib.crc32(own.tobytes()), *([own.tolist()] if with_ids else [])))
                    start, piece = start + length, piece + 1
            cols = list(zip(*out, strict=True)) if out else [[]] * (6 if with_ids else 5)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], names[: len(cols)])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))


def pack(df: DataFrame, capacity: int = 2048, json_path: str | None = None, ranks_path: str | None = None, text_col: str = "text", id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """A row for each piece, with its sequence_id and its offset there; with_ids: also its ids."""
    spark = df.sparkSession
    if json_path is None:
        json_path, ranks_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    cut = materialize(pieces(df, capacity, json_path, ranks_path, text_col, id_col, with_ids=with_ids), "pack-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most one row for each length up to the capacity
    found = _lookup(plan(counts, capacity))
    chunks = shuffle_partitions(spark)
    cut = cut.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)).cast("int"))
    sizes = cut.groupBy("length", "_chunk").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))
    sizes = materialize(sizes.select("length", "_chunk", F.coalesce(before, F.lit(0)).alias("_before")), "pack-chunks")
    if capacity * chunks <= 500_000:  # its row count is at most this
        sizes = F.broadcast(sizes)
    place = F.row_number().over(Window.partitionBy("length", "_chunk").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = cut.withColumn("_place", place).join(sizes, ["length", "_chunk"]).withColumn("_rank", F.col("_place") + F.col("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def at(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        out = np.zeros((2, len(n)), np.int64)
        for s in np.unique(n):
            rows = n == s
            first, sequence, offset = found[int(s)]
            i = np.searchsorted(first, r[rows], "right") - 1
            out[0, rows] = sequence[i] + r[rows] - first[i]
            out[1, rows] = offset[i]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    return ranked.withColumn("_at", at("length", "_rank")).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"), *(["ids"] if with_ids else []))
