"""Nearest neighbours: repeated ids, ties, and routing by cells, against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from lumenweb.llm import ann


def brute(ids, v, k, every):
    """Every row but those of the query's own id; a query is the smallest vector of its id."""
    out = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        own = min((v[j].tolist() for j in np.flatnonzero(ids == q)))
        at = np.flatnonzero(ids != q)
        s = np.array([float(np.einsum("i,i->", v[j], np.array(own))) for j in at])
        order = np.lexsort((ids[at], -s))[:k]
        out[q] = [(int(ids[at][j]), round(s[j], 9)) for j in order]
    return out


def found(spark, ids, v, k=20, every=20):
    df = spark.createDataFrame([(int(i), x.tolist(), "x") for i, x in zip(ids, v)], "vec_id long, embedding array<double>, score string").repartition(5)
    got = defaultdict(list)
    for r in ann.nearest(df, k, every).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    return got


def test_repeated_ids_lose_no_neighbours(spark):
    v = np.ones((26, 4))
    got = found(spark, np.array([20] * 25 + [40]), v)
    assert got == {20: [(40, 4.0)], 40: [(20, 4.0)] * 20}
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 4))
    ids = rng.integers(0, 30, 700)
    v = base[rng.integers(0, 12, 700)]
    want = brute(ids, v, 20, 10)
    assert found(spark, ids, v, 20, 10) == want
    assert all(len(x) == 20 for x in want.values())


@pytest.mark.parametrize("shard", [1 << 30, 2048])
def test_routed_queries_find_what_brute_force_finds(spark, monkeypatch, shard):
    """Clusters, a third of the rows copies of one vector, norms that differ; one cell and many."""
    monkeypatch.setattr(ann, "SHARD_VALUES", shard)
    rng = np.random.default_rng(7)
    n, dim = 3000, 16
    v = rng.normal(size=(40, dim))[rng.integers(0, 40, n)] * 3 + rng.normal(size=(n, dim)) * 0.4
    v[::3] = v[0]
    ids = rng.permutation(n)
    got, want = found(spark, ids, v), brute(ids, v, 20, 20)
    assert set(got) == set(want)
    assert all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    copies = {int(i) for i, x in zip(ids, v) if (x == v[0]).all()}
    assert all(got[q] == want[q] for q in want if q in copies)


def test_cells_hold_and_reach_what_is_near():
    rng = np.random.default_rng(1)
    p = np.concatenate((rng.normal(size=(400, ann.DIMS)), np.tile(rng.normal(size=ann.DIMS), (200, 1))))
    cells = ann.Cells(p[::2], 16)
    at = cells.place(p)
    assert cells.n == 16 and set(at) <= set(range(16))
    low, high = np.full((16, ann.DIMS), np.inf), np.full((16, ann.DIMS), -np.inf)
    np.minimum.at(low, at, p)
    np.maximum.at(high, at, p)
    cells.box(low, high)
    q, bound = rng.normal(size=(50, ann.DIMS)), rng.uniform(0.5, 12, 50)
    reached = set(zip(*(x.tolist() for x in cells.reach(q, bound))))
    for i in range(50):
        for j in np.flatnonzero(((p - q[i]) ** 2).sum(1) <= bound[i]):
            assert (i, at[j]) in reached
    assert len(reached) < 50 * 16
    assert ann.Cells(np.zeros((9, ann.DIMS)), 4).n == 1
    assert ann.Cells(np.zeros((0, ann.DIMS)), 4).n == 1


def test_most_cells_of_clusters_are_left_out():
    """Work grows with what is near: queries of separate clusters reach few cells."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(64, 32)) * 10
    v = centres[rng.integers(0, 64, 6000)] + rng.normal(size=(6000, 32)) * 0.1
    v /= np.linalg.norm(v, axis=1)[:, None]
    top = 1.0
    p = ann._projected(v, top)
    cells = ann.Cells(p, 64)
    at = cells.place(p)
    low, high = np.full((cells.n, ann.DIMS), np.inf), np.full((cells.n, ann.DIMS), -np.inf)
    np.minimum.at(low, at, p)
    np.maximum.at(high, at, p)
    cells.box(low, high)
    shard = ann.Shard(np.arange(6000), v, top, 20)
    q = v[:300]
    _, _, scores = shard.search(np.arange(300), q)
    kth = scores.reshape(300, 20)[:, -1]
    reach = ann.chi_square_quantile(ann.CONFIDENCE, ann.DIMS) * np.maximum(0, 2 * top * top - 2 * kth)
    assert len(cells.reach(ann._projected(q, None), reach)[0]) < 0.1 * 300 * cells.n
    assert shard.verified < 0.3 * 300 * 6000
