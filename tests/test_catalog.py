"""Every query beside its SQL, on the smallest tables."""

from pathlib import Path

import pytest

from lumenweb.plans.catalog import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([round(v, 8) if isinstance(v, float) else v for v in (row[i] for i in order)]) for row in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())


WITHOUT_SQL = sorted(set(QUERIES) - set(ORACLES))
_LABELLED = "SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL"
#: How many rows each of them has.
COUNTS = {
    "h04_text_of_all_pages": "SELECT count(*) FROM pages", "pipeline_on_all_pages": None, "l01_language_of_all_documents": "SELECT count(*) FROM documents", "l26_l27_l28_features": None, "o09_sample_rate": None, "p05_visit_order": None,
    "m17_m20_u05_cross_validation": _LABELLED, "m19_m11_fit_and_predict": _LABELLED, "m18_m29_other_classifiers": _LABELLED, "m22_m30_grid_search": "SELECT 2", "a29_importance": "SELECT 10", "a30_permutation_importance": "SELECT 2",
}


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_without_sql(spark, duck, name):
    """Runs wholly, has the rows that it must have, and each column of a prediction, a share or a rank its range."""
    found = [r.asDict() for r in QUERIES[name](spark, str(DATA)).collect()]
    wanted = COUNTS[name] and duck.execute(COUNTS[name]).fetchone()[0]
    assert found and (wanted is None or len(found) == wanted)
    for r in found:
        assert all(r[c] in (0, 1) for c in ("predicted", "sparse") if c in r)
        assert r.get("forest", 0) in (0, 1, 2)
        assert all(0 <= r[c] <= 1 for c in ("proba", "importance", "accuracy", "precision", "recall", "f1") if r.get(c) is not None)
    if "proba" in (found[0] if found else {}):
        assert all((r["proba"] >= 0.5) == (r["predicted"] == 1) for r in found if abs(r["proba"] - 0.5) > 1e-6)
        assert {r["fold"] for r in found} == {0, 1, 2}


def test_shuffled_order_and_samples_are_stable(spark, duck):
    for name in ("p05_visit_order", "o09_sample_rate"):
        a, b = (sorted(map(tuple, QUERIES[name](spark, str(DATA)).collect()), key=repr) for _ in range(2))
        assert a == b
    n = duck.execute("select count(*) from pages").fetchone()[0]
    assert 0.05 * n < QUERIES["o09_sample_rate"](spark, str(DATA)).count() < 0.45 * n


def test_nearest_rows_in_many_bands(spark, monkeypatch):
    """Exact beside a look at every pair, with a third of all rows equal."""
    import numpy as np

    from lumenweb.operators import training

    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        x = [3.0, 4.0] if i % 3 == 0 else rng.integers(0, 40, 2).astype(float).tolist()
        rows.append((f"u{i:03d}", int(rng.integers(0, 2)), int(rng.integers(0, 2)), x, int(rng.integers(0, 3)), 0, int(rng.integers(0, 300)), int(rng.integers(0, 20))))
    df = spark.createDataFrame(rows, "url string, actual int, predicted int, text_feat array<double>, n_pair_same int, n_pair_successive int, n_words int, n_sentences int").repartition(3)
    v = np.array([[*r[3], r[4], r[5], r[6] / 100, r[7] / 5] for r in rows])
    want = {}
    for i, r in enumerate(rows):
        if r[1] != r[2]:
            best = min((round(float(np.abs(v[i] - v[j]).sum()), 9), rows[j][0]) for j in range(400) if rows[j][1] != r[1])
            want[r[0]] = best[0]
    for band in (20_000, 25):
        got = {r.url: round(r.dist, 9) for r in training.nearest_right(df, band=band).collect()}
        assert got == want
