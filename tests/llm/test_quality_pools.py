"""Documents of rare languages and sources are judged too."""

import random

import numpy as np
import pytest

from lumenweb.llm import qualityrules
from tests.llm.test_pipeline import brute_mcd, brute_quality, vector

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def text():
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    return lambda odd: " ".join(rng.choice(vocab) + ("%%%" if odd else "") for _ in range(rng.randint(60, 400)))


def test_leftovers_are_judged_over_all(spark, text):
    rows = [(i, text(False), "en", "web") for i in range(300)]
    rows += [(1000 + i, text(i % 2 == 1), f"l{i % 5}", "web") for i in range(20)]
    out = {r.doc_id: r.kept for r in qualityrules.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(out[1000 + i] == (i % 2 == 0) for i in range(20))
    assert sum(out[i] for i in range(300)) >= 297


def test_too_small_a_table_rejects_nothing_more(spark, text):
    rows = [(i, text(i == 0), "en", "web") for i in range(60)]
    assert all(r.kept for r in qualityrules.verdicts(spark.createDataFrame(rows, SCHEMA)).collect())


def test_the_estimate_is_the_covariance_determinant(spark, text):
    """Verdicts of groups with correlated, varied statistics beside numpy's; constants alone in place of the estimate do worse."""
    rng = random.Random(17)
    vocab = {k: ["".join(rng.choice("abcdefghij") for _ in range(max(2, round(rng.gauss(n, 2))))) for _ in range(700)] for k, n in (("en", 4), ("de", 9))}
    rows, odd = [], set()
    for i in range(900):
        lang = "en" if i % 2 else "de"
        share = rng.choice([0.05, 0.15, 0.3]) if lang == "en" else 0.15
        size = rng.randint(60, 500)
        words = [rng.choice(vocab[lang]) for _ in range(size)]
        if i % 15 == 0:  # nothing odd by itself: the other language's words
            odd.add(i)
            words = [rng.choice(vocab["de" if lang == "en" else "en"]) for _ in range(size)]
        rows.append((i, " ".join(w + ("." if rng.random() < share else "") for w in words), lang, "web", 0))
    docs = spark.createDataFrame(rows, SCHEMA + ", n_chars long")
    out = {r.doc_id for r in qualityrules.verdicts(docs).collect() if not r.kept}
    want = {r[0] for r in rows} - {r[0] for r in brute_quality(rows)}
    assert out == want
    assert odd <= out and len(out - odd) <= 9
    constants = set()
    for lang in ("en", "de"):
        own = [r for r in rows if r[2] == lang]
        x, n = np.array([vector(r[1]) for r in own]), np.array([len(r[1].split()) for r in own])
        z = (x - np.median(x, 0)) / (np.array(qualityrules.LEAST) / np.sqrt(np.median(n)))
        constants |= {r[0] for r, d in zip(own, (z**2).sum(1)) if d > qualityrules.CUTOFF}
    assert len(constants ^ odd) > 5 * max(1, len(out ^ odd))


def test_determinants_only_fall_and_settle():
    rng = np.random.default_rng(3)
    x = rng.multivariate_normal([0, 0, 0], [[1, 0.8, 0], [0.8, 1, 0], [0, 0, 0.2]], 400) * 0.1
    x[:60] += [0.3, -0.3, 0]
    d, starts = brute_mcd(x, np.full(400, 300))
    assert all(rounds < 20 for _, rounds in starts)
    assert (d[:60] > np.median(d[60:])).mean() > 0.95
