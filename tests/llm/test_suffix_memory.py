"""Suffix arrays: what a task holds at once has a bound, however often a passage occurs. The steps run here without Spark."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lumenweb.llm import suffixdedup

OWNERS, SHARDS = np.arange(3, dtype=np.int32), np.arange(5, dtype=np.int32)
SORTED = ["shard", "key", "id", "h", "first", "part", "more"]


def watch_blocks(monkeypatch):
    sizes, real = [], suffixdedup.equal_windows

    def watched(parts, doc, length=50):
        sizes.append(sum(map(len, parts)))
        return real(parts, doc, length)

    monkeypatch.setattr(suffixdedup, "equal_windows", watched)
    return sizes


def windows(batches):
    """(doc, extra, window) of rows of removed windows."""
    got = set()
    for b in batches:
        for kind, n, payload in zip(b.column("kind").to_pylist(), b.column("n").to_pylist(), b.column("payload").to_pylist()):
            assert kind == 0
            for d, e, f, c in zip(*(x.tolist() for x in suffixdedup._unpack(n, payload))):
                got |= {(d, e, w) for w in range(f, f + c)}
    return got


def brute(texts):
    first = {}
    for d, t in texts:
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(first.get(t[p : p + 50], d), d)
    return {(d, 0, p) for d, t in texts for p in range(len(t) - 49) if first[t[p : p + 50]] < d}


def asked(texts, asks, crowd):
    """Rows for _cut: one owner's requests, then its texts."""
    doc, first, count = (np.array(x, np.int64) for x in zip(*asks))
    (owner, _, n, payload), = suffixdedup._packs(1, OWNERS[:1], doc, 0 * doc, first, count, 0 * doc + 7, 0 * doc + crowd)
    rows = [(owner, 0, n, payload, None, None, None), *((owner, 1, 0, None, d, 0, t) for d, t in texts)]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string())
    return suffixdedup._batch(rows, ["owner", "turn", "n", "payload", "id", "h", "text"], types)


def by_key(batches):
    table = pa.Table.from_batches(batches)
    return table.sort_by("key").to_batches()


def test_anchors_share_an_array_up_to_its_size(monkeypatch):
    sizes = watch_blocks(monkeypatch)
    monkeypatch.setattr(suffixdedup, "BLOCK", 10_000)
    rng = random.Random(3)
    rows = [(0, key, doc, 0, 0, "".join(rng.choice("abcd") for _ in range(90)).encode(), None) for key in range(12) for doc in range(100)]
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    list(suffixdedup._sort_shard(OWNERS, 50)(iter([suffixdedup._batch(rows, SORTED, types)])))
    assert sum(sizes) == 12 * 9000 and max(sizes) <= 10_000


def test_windows_of_one_text_leave_in_parts(monkeypatch):
    monkeypatch.setattr(suffixdedup, "PARTS", 1000)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    batches = list(suffixdedup._cut(SHARDS, 50)(iter([asked([(5, text)], [(5, at, 30) for at in range(0, 29_900, 30)], 8)])))
    assert sum(b.num_rows for b in batches) >= 29_000 and max(b.num_rows for b in batches) <= 1030


def test_equal_windows_of_one_text_are_one_row():
    texts = [(1, "x" * 60), (2, "x" * 50_000 + "yz" * 200)]
    batches = list(suffixdedup._cut(SHARDS, 50)(iter([asked(texts, [(1, 0, 11), (2, 0, 50_351)], 8)])))
    assert sum(b.num_rows for b in batches) < 200
    assert windows(suffixdedup._sort_shard(OWNERS, 50)(iter(by_key(batches)))) == brute(texts)


def test_all_steps_with_a_passage_in_every_text(monkeypatch):
    """An anchor's contents have more bytes than an array may: they are dealt on, also where there are few of them."""
    sizes = watch_blocks(monkeypatch)
    block = 20_000
    monkeypatch.setattr(suffixdedup, "BLOCK", block)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))

    def noise(n):
        return "".join(rng.choice("ijklmnop ") for _ in range(n))

    texts = [(i, noise(rng.randint(40, 80)) + passage + noise(rng.randint(40, 80))) for i in range(1000)]
    texts += [(2000, "xy" * 9000), (2001, "xy" * 9001 + noise(70)), (2002, noise(70) + "xy" * 300)]
    docs = pa.RecordBatch.from_arrays([pa.array([d for d, _ in texts], pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array([t for _, t in texts])], ["i", "h", "t"])
    told = pa.Table.from_batches(suffixdedup._report(SHARDS, OWNERS, 50)(iter([docs]))).sort_by("shard").to_batches()
    first = pa.Table.from_batches(suffixdedup._resolve(iter(told), suffixdedup.CROWD, OWNERS, block, 50))
    gone = first.filter(pc.equal(first["kind"], 0)).to_batches()
    asks = [r for r in first.to_pylist() if r["kind"] == 1]
    owner = OWNERS[suffixdedup._owner(np.array([d for d, _ in texts]), np.zeros(len(texts), np.int64), len(OWNERS))]
    rows = [(r["owner"], 0, r["n"], r["payload"], None, None, None) for r in asks]
    rows += [(int(o), 1, 0, None, d, 0, t) for o, (d, t) in zip(owner, texts)]
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string())
    cut = suffixdedup._batch(sorted(rows, key=lambda r: r[:2]), ["owner", "turn", "n", "payload", "id", "h", "text"], types)
    second = list(suffixdedup._sort_shard(OWNERS, 50)(iter(by_key(list(suffixdedup._cut(SHARDS, 50)(iter([cut])))))))
    assert windows(gone) | windows(second) == brute(texts)
    assert max(sizes) <= block


def test_bytes_of_memory_for_a_byte():
    rng = random.Random(6)
    parts = ["".join(rng.choice("abcdefgh") for _ in range(80)).encode() for _ in range(2500)]
    suffixdedup.equal_windows(parts, np.arange(2500))
    tracemalloc.start()
    suffixdedup.equal_windows(parts, np.arange(2500))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * 200_000


def test_only_what_documents_may_share_is_sorted(monkeypatch):
    """Windows that one document alone has, however often, need no place in a suffix array; the result is as without leaving them out."""
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh") for _ in range(70))
    noise = lambda n: "".join(rng.choice("ijklmnop") for _ in range(n))
    texts = [(i, noise(300) + passage[i % 3 : 60 + i % 7] + noise(300)) for i in range(200)] + [(300, "q" * 4000), (301, noise(20)), (302, noise(4000))]
    parts, doc = [t.encode() for _, t in texts], np.array([d for d, _ in texts])
    sizes, real = [], suffixdedup._sorted_windows

    def watched(parts, doc, length):
        sizes.append(sum(map(len, parts)))
        return real(parts, doc, length)

    monkeypatch.setattr(suffixdedup, "_sorted_windows", watched)
    part, window = suffixdedup.equal_windows(parts, doc)
    assert {(texts[p][0], 0, w) for p, w in zip(part.tolist(), window.tolist())} == brute(texts)
    assert sizes[0] <= 200 * 80
    everything = real(parts, doc, 50)
    assert sorted(zip(part.tolist(), window.tolist())) == sorted(zip(*(x.tolist() for x in everything)))
