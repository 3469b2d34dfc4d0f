"""Removal of byte strings that also start in a document with a smaller id, by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. No document is
compared with all others; equal strings are brought together instead:

1. Every window of LENGTH bytes has an anchor, the smallest hash among its 16-byte strings. Neighbouring windows with
   the same anchor make a run. Equal windows have equal anchors, so only runs of one anchor can share a window. A bundle
   of documents (a few MB) reports its runs as hashes of anchor and content. Of equal runs in a bundle only those of its
   smallest document are reported, the others are settled there; so a passage that a third of all documents hold comes
   from each bundle once, not from each document.
2. A task holds all reports of an anchor. Runs of equal content: all but the smallest document's are removed. Where
   contents differ, a window that two runs share reaches over half of the way from the anchor at least to one side, so
   runs can only share one if the bytes on that side are equal, which a short hash of them tells. The bytes of one run of
   each content are asked for where that is so; a common phrase asks for nothing.
3. Those bytes are put together by anchor, in shards. Windows whose hash only one document of a block has are equal to none
   and are left out. The others' suffix array is made by induced sorting, with permuted common
   prefixes (see suffixarray): neighbours in the array that share LENGTH bytes are equal windows, and all but those of
   the smallest document are removed. An anchor with very many contents, or with more bytes than one array may have, is dealt
   on by its windows' hashes.
4. Each document's removed windows meet its text.

Hashes only say which strings are brought together; a wrong removal would take a collision of 88 bits in step 2.

Edge cases: a null text counts as empty and stays null in ``dedup``; a null id is smaller than all others; rows with one
id are neither smaller nor larger than each other, also if their texts differ; texts of any length are cut in chunks that
overlap; an empty table gives an empty result; extra columns are carried by ``dedup``. Working columns start with
``_sa_``. docs must be deterministic (read from files).
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenweb.llm.common import MIN_LONG, even_keys, materialize, release, shuffle_partitions
from lumenweb.llm.suffixarray import permuted_prefixes, suffix_array

LENGTH, GRAM = 50, 16
#: Bytes of text that are hashed together, and bytes of runs in one suffix array (more only if equal windows of an anchor have more).
CHUNK, BLOCK = 1_000_000, 1_000_000
#: Runs that are settled and reported together: the more, the fewer rows of reports, which are bundles times shards.
REPORTS = 300_000
#: Parts of texts that are put together before they leave, and their bytes.
PARTS, PART_BYTES = 20_000, 4_000_000
#: Results that are put together before they leave.
ENTRIES = 400_000
#: Documents whose texts are cut together.
ROWS = 256
#: Contents of an anchor from which on its windows are dealt on one by one.
CROWD = 4096
_U = np.uint64
_C1, _C2, _C3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xBF58476D1CE4E5B9)
_PLACE = _U(0xFFFFFF)
_BYTES = np.random.default_rng(12345).integers(1, 2**63, 256).astype(np.uint64)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    if kind not in _POWER or len(_POWER[kind]) < n:
        _POWER[kind] = _powers(_BASE if kind == "up" else _INVERSE, max(n, CHUNK + 300_000))
    return _POWER[kind][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _C3
    return x ^ (x >> _U(32))


def runs(a: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """a: bytes of documents on end, ends: where each one ends.

    Returns (first window, number of windows, anchor, content's hash, hash of the bytes left of the anchor, of those right
    of it). The two last are 0 where no window reaches that far; both are 0 if the anchor is found at several places.
    """
    n = len(a)
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 4
    w = a.astype(np.uint64)
    for shift in (1, 2, 4):
        w = w[:-shift] | (w[shift:] << _U(8 * shift))
    m = _mix(w[:-8] * _C1 ^ (w[8:] * _C2 >> _U(7)) ^ w[8:] * _C2)
    del w
    # Of equal hashes the leftmost counts: a hash's low bits give way to its place.
    m = (m & ~_PLACE) | np.arange(len(m), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    if width > reach:
        m = np.minimum(m[: len(m) - (width - reach)], m[width - reach :])
    own = np.repeat(ends, np.diff(np.concatenate(([0], ends))))[: len(m)]
    valid = np.arange(len(m)) + length <= own
    value = m & ~_PLACE
    fresh = np.ones(len(m), bool)
    fresh[1:] = (value[1:] != value[:-1]) | ~valid[:-1] | (own[1:] != own[:-1])
    first = np.flatnonzero(fresh & valid)
    stop = np.flatnonzero(valid & np.concatenate((fresh[1:] | ~valid[1:], [True])))
    count = stop - first + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[a] * _power("up", n), out=sums[1:])
    down = _power("down", n + 1)
    content = (sums[first + count + length - 1] - sums[first]) * down[first]
    place = (m[first] & _PLACE).astype(np.int64)
    single = place == (m[stop] & _PLACE).astype(np.int64)
    half = -(-(length - GRAM) // 2)

    def side(begin: np.ndarray, there: np.ndarray) -> np.ndarray:
        begin = np.where(there, begin, 0)
        x = _mix((sums[begin + half] - sums[begin]) * down[begin]) >> _U(48)
        return np.where(there & single, np.maximum(x, _U(1)), _U(0))

    left = side(place - half, first <= place - half)
    right = side(place + GRAM, stop >= place + GRAM + half - length)
    return first, count, value[first] * _C1, _mix(content ^ count.astype(np.uint64)), left, right


def _planes(x: np.ndarray) -> bytes:
    """Small or repeated numbers, byte by byte, packed."""
    d = np.diff(x.astype(np.int64), prepend=0)
    return zlib.compress(d.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unplanes(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(b), np.uint8).reshape(8, n).T.copy().view(np.int64).ravel())


def _low(x: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _unlow(b: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(b) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(b, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel()


def _settle(key: np.ndarray, content: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, content, doc); for the ordered rows, where (key, content) begins, and whether a row's document is its smallest."""
    order = np.lexsort((doc, content, key))
    k, c, d = key[order], content[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
    return order, new, d == least


_PACKED = "owner int, kind int, n int, payload binary"
_PACKED_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _owner(doc: np.ndarray, extra: np.ndarray, owners: int) -> np.ndarray:
    return (_mix(doc.view(np.uint64) * _C1 ^ extra.view(np.uint64) * _C2) % _U(owners)).astype(np.int64)


def _packs(kind: int, owners: np.ndarray, doc: np.ndarray, extra: np.ndarray, first: np.ndarray, *more: np.ndarray) -> Iterator[tuple]:
    """(owner, kind, rows, payload): documents' rows put together by the owner of the document, so that there are as many rows as owners at most."""
    if not len(doc):
        return
    owner = owners[_owner(doc, extra, len(owners))]
    order = np.lexsort((first, extra, doc, owner))
    columns = [x[order] for x in (doc, extra, first, *more)]
    owner = owner[order]
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)])).tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        parts = [_planes(x[a:b]) for x in columns]
        yield int(owner[a]), kind, b - a, b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _unpack(n: int, payload: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(payload):
        size = int.from_bytes(payload[at : at + 4], "little")
        out.append(_unplanes(payload[at + 4 : at + 4 + size], n))
        at += 4 + size
    return out


def _spans(columns: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc, extra, places of its rows) of columns that begin with doc, extra and first."""
    order = np.lexsort((columns[2], columns[1], columns[0]))
    doc, extra = columns[0][order], columns[1][order]
    bounds = np.concatenate(([0], np.flatnonzero((doc[1:] != doc[:-1]) | (extra[1:] != extra[:-1])) + 1, [len(doc)])).tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield int(doc[a]), int(extra[a]), order[a:b]


def _batch(rows: list[tuple], names: list[str], types: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)


def _packed(rows: Iterator[tuple], n: int = 1024) -> Iterator[pa.RecordBatch]:
    names, some = ["owner", "kind", "n", "payload"], []
    for r in rows:
        some.append(r)
        if len(some) == n:
            yield _batch(some, names, _PACKED_TYPES)
            some = []
    if some:
        yield _batch(some, names, _PACKED_TYPES)


def _report(shards: np.ndarray, owners: np.ndarray, length: int):
    """Step 1. Rows of kind 0 are removed windows, by owner; those of kind 1 are reports, by shard of the anchor."""

    def hashed(ids: list[int], extras: list[int], parts: list[bytes], offsets: list[int]) -> tuple[np.ndarray, ...]:
        """(key, content, left, right, doc, extra, first, count) of the runs of some texts."""
        ends = np.cumsum([len(p) for p in parts])
        first, count, key, content, left, right = runs(np.frombuffer(b"".join(parts), np.uint8), ends, length)
        at = np.searchsorted(ends, first, "right")
        first = first - np.concatenate(([0], ends))[at] + np.array(offsets, np.int64)[at]
        # A key travels as 40 bits, a content as 48, a side as 16.
        return key >> _U(24), content >> _U(16), left.astype(np.uint16), right.astype(np.uint16), np.array(ids, np.int64)[at], np.array(extras, np.int64)[at], first, count.astype(np.int32)

    def bundle(some: list[tuple[np.ndarray, ...]]) -> Iterator[tuple]:
        key, content, left, right, doc, extra, first, count = (np.concatenate(x) for x in zip(*some, strict=True))
        some.clear()
        if not len(first):
            return
        order, _, least = _settle(key, content, doc)
        gone = order[~least]
        for owner, kind, n, payload in _packs(0, owners, doc[gone], extra[gone], first[gone], count[gone]):
            yield int(shards[owner % len(shards)]), kind, owner, n, payload
        keep = np.sort(order[least])
        shard = (key[keep] % _U(len(shards))).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        keep = keep[order]
        cuts = np.searchsorted(shard[order], np.arange(len(shards) + 1)).tolist()
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                k = keep[a:b]
                fields = (_low(key[k], 5), _low(content[k], 6), _low(left[k], 2), _low(right[k], 2), _planes(doc[k]), _planes(extra[k]), _planes(first[k]), _planes(count[k]))
                yield int(shards[s]), 1, 0, b - a, b"".join(len(x).to_bytes(4, "little") + x for x in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, extras, parts, offsets, size = [], [], [], [], 0
        some: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return _batch(list(bundle(some)), ["shard", "kind", "owner", "n", "payload"], types)

        for batch in batches:
            for i, e, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(1, len(raw) - length + 1), CHUNK):
                    part = raw[at : at + CHUNK + length - 1]
                    if len(part) < length:
                        continue
                    ids.append(i)
                    extras.append(e)
                    parts.append(part)
                    offsets.append(at)
                    size += len(part)
                    if size >= CHUNK:
                        some.append(hashed(ids, extras, parts, offsets))
                        ids, extras, parts, offsets, size = [], [], [], [], 0
                        if sum(len(x[0]) for x in some) >= REPORTS:
                            yield flush()
        if ids:
            some.append(hashed(ids, extras, parts, offsets))
        if some:
            yield flush()

    return run


_WIDTHS = (5, 6, 2, 2)


def _across(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row whether its group holds another document."""
    order = np.argsort(group, kind="stable")
    g, d = group[order], doc[order]
    begins = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    size = np.diff(np.append(begins, len(g)))
    out = np.zeros(len(g), bool)
    out[order] = np.repeat(np.minimum.reduceat(d, begins) != np.maximum.reduceat(d, begins), size)
    return out


def _resolve(batches: Iterator[pa.RecordBatch], many: int, owners: np.ndarray, most: int = BLOCK, length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Step 2. Kinds of rows that leave: 0 removed windows; 1 runs whose bytes are wanted. Rows come by shard, and one shard at a time is in memory."""
    now, reports = None, []
    found: list[list[tuple]] = [[], []]
    entries = 0

    def resolve() -> None:
        nonlocal entries
        for told, columns in zip(found, _resolve_shard(reports, many, most, length), strict=True):
            if len(columns[0]):
                told.append(columns)
                entries += len(columns[0])

    def leave() -> Iterator[pa.RecordBatch]:
        nonlocal entries
        for kind, told in enumerate(found):
            if told:
                yield from _packed(_packs(kind, owners, *(np.concatenate(x) for x in zip(*told, strict=True))))
        found[0], found[1], entries = [], [], 0

    for batch in batches:
        passed = []
        for shard, kind, owner, n, payload in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if kind == 0:
                passed.append((owner, 0, n, payload))
                continue
            if shard != now and reports:
                resolve()
                reports = []
                if entries > ENTRIES:
                    yield from leave()
            now = shard
            reports.append((n, payload))
        yield from _packed(iter(passed))
    if reports:
        resolve()
    yield from leave()


def _resolve_shard(reports: list[tuple[int, bytes]], many: int, most: int, length: int) -> tuple[tuple, tuple]:
    """(doc, extra, first, count) of what is removed, and (doc, extra, first, count, key, crowd) of what is asked for. Anchors of over ``many`` contents or ``most`` bytes are crowded: their windows are dealt in ``crowd`` parts."""
    got: list[list[np.ndarray]] = [[] for _ in range(8)]
    for n, payload in reports:
        fields, at = [], 0
        for _ in range(8):
            size = int.from_bytes(payload[at : at + 4], "little")
            fields.append(payload[at + 4 : at + 4 + size])
            at += 4 + size
        for x, y in zip(got, (*map(_unlow, fields, _WIDTHS), *(_unplanes(f, n) for f in fields[4:])), strict=True):
            x.append(y)
    key, content, left, right, doc, extra, first, count = (np.concatenate(x) for x in got)
    del got
    order, _, least = _settle(key, content, doc)
    gone, kept = order[~least], order[least]
    removed = doc[gone], extra[gone], first[gone], count[gone]
    # One document's run of each content is left; those of an anchor that may share a window are looked at.
    key, left, right, doc, extra, first, count = (x[kept] for x in (key, left, right, doc, extra, first, count))
    ask = np.zeros(len(key), bool)
    for side in (left, right):
        some = np.flatnonzero(side)
        if len(some):
            ask[some] |= _across(key[some] << _U(16) | side[some], doc[some])
    wild = (left == 0) & (right == 0)
    if wild.any():
        ask |= np.isin(key, np.unique(key[wild])) & _across(key, doc)
    key, doc, extra, first, count = (x[ask] for x in (key, doc, extra, first, count))
    _, at, size = np.unique(key, return_inverse=True, return_counts=True)
    at = at.ravel()
    windows = np.bincount(at, weights=count, minlength=len(size)).astype(np.int64)
    crowded = (size > many) | (windows + size * (length - 1) > most)
    crowd = np.where(crowded, np.maximum(-(-windows * length // max(1, most // 4)), 2), 1)[at]
    return removed, (doc, extra, first, count, key.view(np.int64), crowd)


def _cut(shards: np.ndarray, length: int):
    """Step 3, first half: the bytes of the runs that are wanted, by the shard of their anchor. Rows come by owner, requests before texts.

    Windows of a crowded anchor leave one by one; equal ones of a text are one row, ``more`` has their other places. Of those
    that some PARTS rows hold, only those of the smallest document go on to the shard; the others are removed already, and
    leave as rows without bytes that are dealt by document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "key", "id", "h", "first", "part", "more"]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        now, asks, wanted = None, [], None
        deal, n_shards = shards.tolist(), len(shards)
        out: list[list] = []
        size = 0
        # Rows of out by anchor and window: the smallest document's, and the present text's.
        seen: dict[tuple[int, bytes], int] = {}
        own_rows: dict[tuple[int, bytes], int] = {}

        def window(k: int, crowd: int, i: int, h: int, w: int, part: bytes) -> None:
            own = (k * 1_000_003 + zlib.crc32(part) % crowd) % 2**62
            mine = own_rows.get((own, part))
            if mine is not None:
                if out[mine][6] is None:
                    out[mine][6] = array("q")
                out[mine][6].append(w)
                return
            row, here = [deal[own % n_shards], own, i, h, w, part, None], len(out)
            place = own_rows[own, part] = seen.setdefault((own, part), here)
            if place != here:
                if i < out[place][2]:
                    row, out[place] = out[place], row
                else:
                    own_rows[own, part] = here
                if row[2] != i or out[place][2] != i:
                    row[0], row[1], row[5] = deal[(row[2] ^ row[4]) % n_shards], 0, b""
            out.append(row)

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            for row in out:
                row[6] = None if row[6] is None else row[6].tobytes()
            rows, out, size = out, [], 0
            seen.clear()
            own_rows.clear()
            return _batch(rows, names, types)

        for batch in batches:
            for owner, n, payload, i, h, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4, 5)), batch.column(6), strict=True):
                if owner != now:
                    now, asks, wanted = owner, [], None
                if payload is not None:
                    asks.append(_unpack(n, payload))
                    continue
                if not asks:
                    continue
                if wanted is None:
                    columns = [np.concatenate(x) for x in zip(*asks, strict=True)]
                    asks = [()]
                    wanted = {(d, e): at for d, e, at in _spans(columns)}
                at = wanted.get((i, h))
                if at is None:
                    continue
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                own_rows.clear()
                for f, c, k, crowd in zip(*(x[at].tolist() for x in columns[2:]), strict=True):
                    if crowd == 1:
                        out.append([deal[k % n_shards], k, i, h, f, raw[f : f + c + length - 1], None])
                        size += c + length - 1
                    else:
                        for w in range(f, f + c):
                            window(k, crowd, i, h, w, raw[w : w + length])
                        size += 8 * c
                    if len(out) >= PARTS or size >= PART_BYTES:
                        yield flush()
        if out:
            yield flush()

    return run


def shared_stretches(parts: list[bytes], doc: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(part, first byte, bytes) of what a suffix array has to decide on: stretches of windows of which another document's part may hold one.

    Equal windows have equal hashes, so a window whose hash no other document has is equal to none and needs no place in an
    array. Which windows are equal is for the array to tell: two that share a hash by chance are both in it.
    """
    size = np.array([len(p) for p in parts], np.int64)
    start = np.cumsum(size) - size
    a = np.frombuffer(b"".join(parts), np.uint8)
    n = len(a) - length + 1
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    if n <= 0:
        return nothing
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTES[a] * _power("up", len(a)), out=sums[1:])
    own = np.repeat(np.arange(len(parts), dtype=np.int32), size)[:n]
    valid = np.flatnonzero(np.arange(n) + length <= (start + size)[own])
    if not len(valid):
        return nothing
    hashed = _mix((sums[valid + length] - sums[valid]) * _power("down", n)[valid])
    del sums
    order = np.argsort(hashed)
    hashed, places = hashed[order], valid[order]
    del order, valid
    begins = np.flatnonzero(np.concatenate(([True], hashed[1:] != hashed[:-1])))
    owners = doc[own[places]]
    across = np.minimum.reduceat(owners, begins) != np.maximum.reduceat(owners, begins)
    keep = np.sort(places[np.repeat(across, np.diff(np.append(begins, len(places))))])
    if not len(keep):
        return nothing
    # Neighbouring windows of a part are one stretch.
    new = np.concatenate(([True], (np.diff(keep) > 1) | (own[keep[1:]] != own[keep[:-1]])))
    first, last = keep[new], keep[np.append(np.flatnonzero(new)[1:] - 1, len(keep) - 1)]
    part = own[first].astype(np.int64)
    first_byte = first - start[part]
    return part, first_byte, [parts[p][f : f + m] for p, f, m in zip(part.tolist(), first_byte.tolist(), (last - first + length).tolist(), strict=True)]


def _sorted_windows(parts: list[bytes], doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, window) of each window that also starts in a part of a smaller document: suffix array, common prefixes, runs of neighbours that share length bytes."""
    size = np.array([len(p) for p in parts], np.int64)
    t = np.ones(size.sum() + len(parts) + 1, np.uint16)
    start = np.cumsum(size + 1) - size - 1
    own_part = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    inside = np.arange(len(own_part), dtype=np.int32) + own_part
    t[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 2
    t[-1] = 0
    sa = suffix_array(t, 258)
    shared = permuted_prefixes(t, sa, start, int(size.max()))
    part = np.full(len(t), -1, np.int32)
    part[inside] = own_part
    valid = np.zeros(len(t), bool)
    valid[inside] = inside + length <= (start + size)[own_part]
    del inside, own_part
    group = np.cumsum(shared[sa] < length, dtype=np.int32)
    keep = valid[sa]
    at, group = sa[keep], group[keep]
    del shared, sa, valid, keep
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    own = doc[part[at]]
    least = np.repeat(np.minimum.reduceat(own, begins), np.diff(np.concatenate((begins, [len(at)]))))
    at = at[own > least]
    return part[at], at - start[part[at]]


def equal_windows(parts: list[bytes], doc: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(part, window) of each window that also starts in a part of a smaller document."""
    source, first, parts = shared_stretches(parts, doc, length)
    if not parts:
        return source, first
    part, window = _sorted_windows(parts, doc[source], length)
    return source[part], first[part] + window


def _sort_shard(owners: np.ndarray, length: int):
    """Step 3, second half. Rows come sorted by anchor; anchors share an array as long as they have BLOCK bytes at most."""

    def block(rows: list[tuple]) -> list[tuple[np.ndarray, ...]]:
        """(doc, extra, window) of what is removed."""
        parts, doc = [r[4] for r in rows], np.array([r[1] for r in rows], np.int64)
        part, window = equal_windows(parts, doc, length)
        extra, first = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
        return [(doc[part], extra[part], first[part] + window), *(more(rows[at]) for at in np.unique(part).tolist() if rows[at][5])]

    def more(row: tuple) -> tuple[np.ndarray, ...]:
        places = np.frombuffer(row[5] or b"", np.int64)
        return np.full(len(places), row[1]), np.full(len(places), row[2]), places

    def leave(found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        doc, extra, first = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        order = np.lexsort((first, extra, doc))
        doc, extra, first = doc[order], extra[order], first[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (extra[1:] != extra[:-1]) | (first[1:] > first[:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(doc)) - 1
        if len(begin):
            yield from _packed(_packs(0, owners, doc[begin], extra[begin], first[begin], first[last] - first[begin] + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole anchors that share an array, and the present anchor.
        rows: list[tuple] = []
        last: list[tuple] = []
        size, last_size, entries = 0, 0, 0
        found: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            gone: list[tuple] = []
            for r in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4, 5, 6)), strict=True):
                if not r[4]:
                    gone.append(r)
                    continue
                if last and r[0] != last[-1][0]:
                    rows.extend(last)
                    size, last, last_size = size + last_size, [], 0
                if rows and size + last_size + len(r[4]) > BLOCK:
                    got = block(rows)
                    found += got
                    entries += sum(len(x[0]) for x in got)
                    rows, size = [], 0
                    if entries >= ENTRIES:
                        yield from leave(found)
                        entries = 0
                last.append(r)
                last_size += len(r[4])
            if gone:
                found.append(tuple(np.array([r[1:4] for r in gone], np.int64).T))
                got = [more(r) for r in gone if r[5]]
                found += got
                entries += len(gone) + sum(len(x[0]) for x in got)
            if entries >= ENTRIES:
                yield from leave(found)
                entries = 0
        if rows or last:
            found += block(rows + last)
        yield from leave(found)

    return run


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, spans) of each document. Rows come by owner."""

    def documents(got: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*got, strict=True)]
        rows = [(d, e, np.column_stack((columns[2][at], columns[3][at])).astype("<i8").tobytes()) for d, e, at in _spans(columns)]
        return _batch(rows, ["id", "h", "spans"], (pa.int64(), pa.int64(), pa.binary()))

    now, got = None, []
    for batch in batches:
        for owner, n, payload in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
            if owner != now and got:
                yield documents(got)
                got = []
            now = owner
            got.append(_unpack(n, payload))
    if got:
        yield documents(got)


def removed_windows(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """keyed: _sa_id, _sa_h, _sa_text. Returns (id, h, spans): packed (first window, number of windows) of each document that loses bytes."""
    spark = keyed.sparkSession
    parts = shuffle_partitions(spark)
    shards, owners = even_keys(4, parts), even_keys(1, parts)
    told = keyed.select("_sa_id", "_sa_h", "_sa_text").mapInArrow(_report(shards, owners, length), "shard int, kind int, owner int, n int, payload binary")
    many, most = CROWD, BLOCK
    first = materialize(told.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(lambda batches: _resolve(batches, many, owners, most, length), _PACKED), "suffix-first")
    release(spark)

    @F.pandas_udf("int")
    def owner(i: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(owners[_owner(i.to_numpy(), h.to_numpy(), len(owners))])

    none = F.lit(None)
    asks = first.where("kind = 1").select("owner", F.lit(0).alias("turn"), "n", "payload", none.cast("long").alias("id"), none.cast("long").alias("h"), none.cast("string").alias("text"))
    texts = keyed.select(owner("_sa_id", "_sa_h").alias("owner"), F.lit(1).alias("turn"), F.lit(0).alias("n"), none.cast("binary").alias("payload"), F.col("_sa_id").alias("id"), F.col("_sa_h").alias("h"), F.col("_sa_text").alias("text"))
    both = asks.union(texts).repartition(parts, "owner").sortWithinPartitions("owner", "turn")
    bytes_ = both.mapInArrow(_cut(shards, length), "shard int, key long, id long, h long, first long, part binary, more binary")
    second = materialize(bytes_.repartition(parts, "shard").sortWithinPartitions("key").mapInArrow(_sort_shard(owners, length), _PACKED), "suffix-second")
    release(spark)
    return first.where("kind = 0").union(second).repartition(parts, "owner").sortWithinPartitions("owner").mapInArrow(_by_document, "id long, h long, spans binary")


def cut_text(raw: bytes, spans: bytes | None, length: int = LENGTH) -> tuple[bytes, int]:
    """(what is left, number of removed runs)."""
    if not spans:
        return raw, 0
    at = np.frombuffer(spans, "<i8").reshape(-1, 2)
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, at[:, 0], 1)
    np.add.at(edge, at[:, 0] + at[:, 1] + length - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])


def _joined(docs: DataFrame, text_col: str, id_col: str, length: int) -> DataFrame:
    """docs with _sa_text and _sa_spans."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_LONG))
    twice = docs.groupBy(key.alias("k")).count().where("count > 1").limit(1).count() > 0
    # Where ids are not unique, a text's hash tells the rows apart.
    keyed = docs.withColumns({"_sa_id": key, "_sa_h": F.xxhash64(text_col) if twice else F.lit(0).cast("long"), "_sa_text": F.col(text_col).cast("string")})
    spans = removed_windows(keyed, length).select(F.col("id").alias("_sa_id"), F.col("h").alias("_sa_h"), F.col("spans").alias("_sa_spans"))
    return keyed.join(spans, ["_sa_id", "_sa_h"], "left")


def dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, removed: str = "n_removed", spans: str = "n_spans") -> DataFrame:
    """docs with the remaining text (characters of which a byte is removed go wholly), and how many bytes and runs went; columns of these two names are replaced."""
    names = [c for c in docs.columns if c not in (removed, spans)]
    at = names.index(text_col)
    joined = _joined(docs, text_col, id_col, length).select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in names], "_sa_spans")
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField(removed, T.LongType()), T.StructField(spans, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                texts, gone, runs_ = [], [], []
                for t, s in zip(part.column(at), part.column(len(names)), strict=True):
                    text = t.as_py()
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    kept, n = cut_text(raw, s.as_py(), length)
                    texts.append(text if n == 0 else kept.decode("utf-8", "ignore"))
                    gone.append(len(raw) - len(kept))
                    runs_.append(n)
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64()), pa.array(runs_, pa.int64())], [*names, removed, spans])

    return joined.mapInArrow(run, schema)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                kept, n = cut_text(raw, spans.as_py(), length)
                out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", "doc_id", length)
    return joined.select("doc_id", "_sa_text", "_sa_spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
