"""Sharding, near-duplicates, packing and BPE against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from lumenweb.llm import bpe, packing, sharding, simhash
from lumenweb.llm.bktree import Forest, merge
from lumenweb.llm.components import connected_components


def test_shards(docs, rows, empty):
    out = sharding.shard_digests(docs).collect()
    assert Counter((r.doc_id, r.text_crc32, r["size"]) for r in out) == Counter((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t, *_ in rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    assert set(by) <= set(range(16))
    assert sharding.shard_digests(empty).count() == 0
    assert "extra" in sharding.shard(docs).columns


def test_shards_are_equal_and_keep_groups(spark):
    rng = random.Random(1)
    rows = [(i, "hot " * 20 if i % 3 == 0 else f"{rng.random()}" * rng.randint(1, 9)) for i in range(6000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = Counter()
    for r in out:
        size[r.shard] += len(r.text) + 1
    mean = sum(size.values()) / 16
    assert len(size) == 16
    assert max(abs(s - mean) for s in size.values()) < 0.02 * mean
    placed = [(r.shard, r.slot) for r in out]
    assert len(set(placed)) == len(placed)


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=4):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(fps))]


def test_near_duplicates(docs, rows, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [brute_fp(t) for _, t, *_ in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((d, f"{f:016x}") for (d, *_), f in zip(rows, fps))
    root = brute_components(fps)
    least = {}
    for (d, *_), c in zip(rows, root):
        least[c] = min([x for x in (d, least.get(c)) if x is not None], default=None)
    assert {(r.doc_id, r.component_id) for r in got} == {(d, least[c]) for (d, *_), c in zip(rows, root)}
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_clustered_fingerprints(spark, monkeypatch):
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(6)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centre for _ in range(150)} | {0, 2**64 - 1})
    want = brute_components(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    for size in (50_000, 40):  # whole shards; shards cut in slices
        monkeypatch.setattr(simhash, "SLICE", size)
        roots = dict(connected_components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))).collect())
        got = [roots.get(f, f) for f in signed]
        pairs = set(zip(got, want))
        assert len(pairs) == len(set(got)) == len(set(want))


def plain_tree(items):
    """A BK-tree as dicts: (item's place, {edge: node})."""
    root = (0, {})
    for i in range(1, len(items)):
        at = root
        while True:
            d = (items[at[0]] ^ items[i]).bit_count()
            if d == 0:
                break
            if d not in at[1]:
                at[1][d] = (i, {})
                break
            at = at[1][d]
    return root


def test_bk_trees_are_searched_along_edges_within_the_radius():
    rng = np.random.default_rng(0)
    a = np.unique(np.concatenate((rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(0, 4096, 500).astype(np.uint64))))
    a = rng.permutation(a)
    tree = rng.integers(0, 7, len(a)) * 3
    forest = Forest(a, tree, 4)
    got = {(int(i), int(j)) for x, y in forest.search(a, tree) for i, j in zip(x, y)}
    near = (np.bitwise_count(a[:, None] ^ a[None, :]) <= 4) & (tree[:, None] == tree[None, :])
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near))))
    visits = 0
    for t in set(tree.tolist()):
        items = [int(x) for x in a[tree == t]]
        root = plain_tree(items)
        for q in items:
            stack = [root]
            while stack:
                i, edges = stack.pop()
                visits += 1
                d = (items[i] ^ q).bit_count()
                stack += [c for e, c in edges.items() if abs(e - d) <= 4]
    assert forest.visited == visits < sum((tree == t).sum() ** 2 for t in set(tree.tolist()))
    assert list(forest.search(a[:3], np.array([1, 2, 4]))) == []


def test_twins_and_whole_subtrees():
    a = np.array([5, 5, 5, 7, 2**60, 2**60], np.uint64)
    forest = Forest(a, np.zeros(6, np.int64), 4)
    labels = merge(np.arange(6), *forest.met)
    assert labels.tolist() == [0, 0, 0, 0, 0, 0] or labels.tolist() == [0, 0, 0, 0, 4, 4]
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 12)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 12))]
        want = list(range(n))
        for _ in range(n):
            for x, y in pairs:
                want[x] = want[y] = min(want[x], want[y])
        assert merge(np.arange(n), np.array([x for x, _ in pairs], np.int64), np.array([y for _, y in pairs], np.int64)).tolist() == want


def test_every_shard_is_a_tree_and_near_copies_cost_no_pairs(monkeypatch):
    made = []
    monkeypatch.setattr(simhash, "Forest", lambda *x: made.append(Forest(*x)) or made[-1])
    rng = np.random.default_rng(4)
    few = rng.integers(0, 2**63, 400).astype(np.uint64)
    key = few % np.uint64(150)
    simhash.shard_links(key, few, np.zeros(400, np.int32), 4)
    assert len(made[0].trees) == len(set(key.tolist())) and made[0].visited >= 400 - len(made[0].trees)
    centre = np.uint64(rng.integers(0, 2**63))
    copies = np.unique(np.array([centre ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(6000)], np.uint64))
    u, v = simhash.shard_links(np.zeros(len(copies), np.uint64), copies, np.zeros(len(copies), np.int32), 4)
    assert len(u) == len(copies) - 1 and len(set(v.tolist())) == 1
    assert made[1].visited < 0.05 * len(copies) ** 2


def test_keys_bring_all_near_ones_together():
    rng = random.Random(6)
    for n in (0, 1, 100, 9000, 250_000, 10**7, 10**9, 10**11):
        masks = [int(m) for m in simhash._masks(n, 4)]
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4)))
            assert any(a & m == b & m for m in masks)


def test_packing(docs, rows, empty):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(docs, with_ids=True).collect()
    want = Counter()
    for d, text, *_ in rows:
        want[(d, tuple(t.encode(text or "", add_special_tokens=False).ids) + (0,))] += 1
    pieces = defaultdict(list)
    for r in out:
        assert r.length == len(r.ids) <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.doc_id].append(r)
    for d, p in pieces.items():
        n = sum(k for (x, _), k in want.items() if x == d)
        p.sort(key=lambda r: r.piece)
        if n == 1:
            assert [r.piece for r in p] == list(range(len(p)))
            assert tuple(i for r in p for i in r.ids) == next(i for x, i in want if x == d)
            assert [r.start for r in p] == [sum(q.length for q in p[:i]) for i in range(len(p))]
            assert all(r.length == 2048 for r in p[1:])
    seq = defaultdict(list)
    for r in out:
        seq[r.sequence_id].append((r.offset, r.length))
    for s in seq.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(empty).count() == 0


def test_plan_is_tight():
    rng = random.Random(5)
    sizes = Counter(min(2048, int(rng.lognormvariate(6.2, 1)) + 1) for _ in range(30000))
    plan = packing.plan(dict(sizes), 2048)
    used = Counter()
    for n, items in plan:
        assert sum(s * k for s, k in items) <= 2048
        for s, k in items:
            used[s] += n * k
    assert used == sizes
    assert sum(n for n, _ in plan) <= 1.01 * max(sum(s * k for s, k in sizes.items()) / 2048, sum(k for s, k in sizes.items() if s > 1024)) + 1


def test_fast_tokenizer_has_the_same_ids():
    js, rk = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    t = Tokenizer.from_file(js)
    for s in ["", " ", "a  b\n\n c\t", "<|endoftext|> x<|endoftext|>y", "don't WE'LL 'S", "é́ 漢字 🙂  x y", "1234 12a", "_" * 3000, " " * 5000 + "x", "\n" * 3000, "\x00\x1c\x85 z"]:
        assert packing.encode(s, js, rk).tolist() == t.encode(s, add_special_tokens=False).ids


def test_bpe(docs, rows, empty):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def one(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    assert Counter(tuple(r) for r in bpe.digests(docs).collect()) == Counter((d, *one(x)) for d, x, *_ in rows)
    assert bpe.digests(empty).count() == 0


def test_forced_boundaries_on_odd_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t, c = Tokenizer.from_file(path), bpe.Codec(path)
    assert len(c.cuts) > 100
    rng = random.Random(9)
    chars = list("abzAQé'.,!?-_<>|#12  \n\t ̸́ß İΣ漢🙂stldremv") + ["'s", "'ll", "<|endoftext|>", "<|startoftext|>", "...", "https://"]
    for _ in range(3000):
        s = "".join(rng.choice(chars) for _ in range(rng.randint(0, 30)))
        want = t.encode(s, add_special_tokens=False).ids
        assert c.encode(s) == want, s
        assert c.encode_digest(s)[2].decode() == t.decode(want, skip_special_tokens=False)
