"""Toxicity, quality, nearest neighbours, URL filter, quality rules and suffix arrays: brute force, exact cases, held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenweb.llm import ann, quality, qualityrules, suffixdedup, toxicity, urlfilter
from lumenweb.llm.suffixarray import permuted_prefixes, suffix_array


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    docs, labels = [], []
    for i in range(1200):
        bad, good = rng.random() < 0.3, rng.random() < 0.6
        w = [rng.choice(vocab) for _ in range(rng.randint(5, 120))]
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["zorgil", "zorgon", "moron", "vapplen"])
        text = " ".join(w) if good else " | ".join(x.upper() + "!!" for x in w) if not bad else "%%% ".join(w)
        docs.append((i, text, rng.choice(["en", "de"]), f"src{i % 3}", len(text), "x"))
        labels.append((i, int(good), int(bad)))
    docs += [(5000, None, None, None, None, None), (None, "plain words", "en", None, 3, None), (5001, "", "en", "s", 0, "")]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, toxic string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_holds_out(labelled):
    docs, labels = labelled
    out = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2) for d, r in out.items())
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [d for d, r in out.items() if r.held_out and d in truth]
    assert sum(out[d].predicted == truth[d] for d in held) / len(held) > 0.97
    assert out[5000].score == out[5001].score == 0


def test_toxicity_without_rows(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.scores(empty, none).count() == 0
    docs = spark.createDataFrame([(1, "you are an idiot"), (2, "a fine day")], "doc_id long, text string")
    assert [r.predicted for r in toxicity.scores(docs, none).orderBy("doc_id").collect()] == [1, 0]


def test_grammar_contexts():
    s = toxicity.Scorer([("idiot", False, "I", 0.9), ("kill", False, "T", 0.6), ("zorg", True, "I", 0.9)])
    plain, aimed, negated, told = (s.score(t) for t in ("what an idiot", "you are an idiot", "never an idiot", "someone said idiot"))
    assert negated < told < plain < aimed
    assert s.score("i will kill you") > 0.3 > s.score("kill the lights")
    assert s.score("not here. idiot") == pytest.approx(plain)
    assert s.score("zorgilla") == pytest.approx(plain)
    assert s.score("aidiot idiots") == 0
    assert s.score("x " * 50_000 + "idiot") == pytest.approx(plain)
    assert s.score(None) == s.score("") == 0


def test_composition():
    a, b = toxicity._near("N", 2, {"I": 0.5}), toxicity._near("R", 1, {"I": 0.2})
    assert a.then(b).factors("NRI") == [1.0, 1.0, 0.1]
    assert a.then(b).factors("NOOI") == [1.0, 1.0, 1.0, 1.0]
    assert a.then(b).factors("N.I") == [1.0, 1.0, 1.0]


def test_quality(labelled, empty, spark):
    docs, labels = labelled
    out = quality.scores(docs, labels).collect()
    assert len(out) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    assert quality.scores(empty, labels).count() == 0


def test_co_training_uses_the_other_view(spark):
    """The text view can't tell the classes from its few labels; the metadata view is sure of documents and names them, all of them."""
    rng = np.random.default_rng(0)
    n = 3000
    y = np.tile([0, 1], n // 2)
    cells = np.array([quality.metadata_view("en", f"src{label}", 100 + i % 7) for i, label in enumerate(y)])
    text = (rng.normal(0, 1, (n, 60)) + (y[:, None] * 2 - 1) * 0.3).astype(np.float16)
    known = quality.Sums.none(60)
    for label in (0, 1):
        at = np.flatnonzero(y[:40] == label)
        known.add(label, text[at], cells[at])
    free = spark.createDataFrame([(bytearray(t.tobytes()), c.tolist()) for t, c in zip(text[240:2000], cells[240:2000])], "a binary, b array<int>").repartition(3)
    held = text[40:240].astype(np.float32), cells[40:240], y[40:240]
    right = lambda v: ((v.text.raw(text[2000:].astype(np.float32)) > 0) == y[2000:]).mean()
    alone, taught = quality.co_train(free, known, held, rounds=0), quality.co_train(free, known, held)
    assert right(alone) < 0.95 and right(taught) > 0.97
    counted = quality.Sums.of(np.concatenate((known.flat()[:2] * 0 + 5, known.flat()[2:])), 60)
    assert counted.n.tolist() == [5, 5] and (counted.cells == known.cells).all()


def test_conflicting_labels_and_clashing_columns(spark, labelled):
    docs, labels = labelled
    both = labels.union(labels.where("doc_id % 40 = 0").selectExpr("doc_id", "1 - quality", "toxic")).repartition(3)
    wide = docs.withColumns({c: F.lit("x") for c in ("y", "h", "a", "b", "x", "score", "predicted", "held_out", "quality")})
    first, second = ({(r.doc_id, r.score) for r in quality.scores(wide, t).collect()} for t in (both, both.orderBy("quality", F.desc("doc_id"))))
    assert first == second


def test_nearest(spark, empty):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, (900, 1))
    v[500:560] = v[500]
    rows = [(i, x.tolist(), "e") for i, x in enumerate(v)] + [(901, None, ""), (902, [0.0] * 16, ""), (903, [float("nan")] + [1.0] * 15, ""), (904, [None] + [1.0] * 15, ""), (905, [1.0], ""), (906, [float("inf")] * 16, ""), (None, [1.0] * 16, ""), (920, None, "")]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        s = v @ v[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        hits += len(set(best.tolist()) & {i for i, _ in found})
        assert [r for r in found] == sorted(found, key=lambda x: (-x[1], x[0]))
        assert len(found) == 20
        assert np.allclose([x for _, x in found], [v[i] @ v[q] for i, _ in found], rtol=1e-12)
    assert hits / (20 * len(got)) >= 0.95
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(few).orderBy("rank").collect()] == [(0, 2), (0, 1)]
    assert ann.nearest(spark.createDataFrame([], few.schema)).count() == 0


def test_chi_square():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-2)
    assert ann.chi_square_quantile(0.99, 2) == pytest.approx(9.210, abs=1e-2)


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        after = rest[len(host) :]
        path = re.split(r"[?#]", after, maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for says, h, p in urlfilter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, says)
    return host, path, best


def test_urls(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y=/z#q", "http://example.com", "http://notexample.com/en/", "http://a.example.com/en/?x", "https://x.net/es/1", "https://x.net/esx", "http://x.net?/fr/", "http://u:p@net/fr/é", "x://y://z/a", "http://com/", "http://ÄÖ.org/ß\nq"]
    urls += [f"http{rng.choice(['', 's'])}://{rng.choice(['a', 'www', 'b-c'])}.{rng.choice(['example', 'other'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.randint(1, 999)}{rng.choice(['', '?a=1&b=2', '#t'])}" for _ in range(600)]
    pages = spark.createDataFrame([(i, u, "host") for i, u in enumerate(urls)] + [(0, None, "")], "page_id long, url string, host string")
    out = urlfilter.judge(pages).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        host, path, best = brute_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")
    ruled = [r for r in out if r.rule]
    assert sum((r.margin > 0) == (r.verdict == "block") for r in ruled) / len(ruled) > 0.9
    assert urlfilter.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages.where("url is null")).collect()} == {"allow"}


def brute_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen = 0, set()
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            lines += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), lines, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_quality_rules(spark, docs, rows, empty):
    more = [(2000 + i, t, "en", "src0", 0, "") for i, t in enumerate(["a b c a b c", "a b c d\n\x0b\n a b c d\n\na b c d", "\u00a0 \u2003x ## $%&|<>*", "x y z " * 3000, "a a a a a", "é🙂 é🙂 ﬁ"])]
    both = docs.union(spark.createDataFrame(more, docs.schema))
    out = qualityrules.verdicts(both).collect()
    want = Counter((d, *brute_rules(t)) for d, t, *_ in rows + more)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == want
    assert not any(r.kept and r.base_failed for r in out)
    assert qualityrules.verdicts(empty).count() == 0
    kept = qualityrules.keep(both)
    assert kept.columns == both.columns
    assert kept.count() == sum(r.kept for r in out)


def test_outliers_are_rejected(spark):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def text(odd):
        w = [rng.choice(vocab) for _ in range(rng.randint(60, 400))]
        return " ".join(x + ("%%%" if odd else "") for x in w)

    rows = [(i, text(i % 7 == 0), "en" if i % 3 else None, "hot" if i % 4 else "cold") for i in range(1500)]
    rows += [(9000 + i, text(False), "fr", f"rare{i}") for i in range(5)]
    out = {r.doc_id: r.kept for r in qualityrules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[i] for i in range(0, 1500, 7))
    clean = [out[i] for i in range(1500) if i % 7]
    assert sum(clean) >= 0.998 * len(clean)
    assert all(out[9000 + i] for i in range(5))


def brute_cut(rows, length=50):
    first = {}
    for d, t, *_ in rows:
        b, d = (t or "").encode(), -(2**63) if d is None else d
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, d), d)
    for d, t, *_ in rows:
        b, own = (t or "").encode(), -(2**63) if d is None else d
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < own:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        yield d, len(b), len(b) - len(kept), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()


def test_suffix_dedup(docs, rows, empty):
    assert Counter(tuple(r) for r in suffixdedup.digests(docs).collect()) == Counter(brute_cut(rows))
    assert suffixdedup.digests(empty).count() == 0
    left = suffixdedup.dedup(docs)
    assert left.columns == [*docs.columns, "n_removed", "n_spans"]
    assert left.where("text is null").count() == 2
    named = suffixdedup.dedup(docs.withColumn("n_removed", F.lit("theirs")), removed="_r", spans="_s")
    assert named.select("n_removed").distinct().collect()[0][0] == "theirs"


def test_suffix_dedup_of_hard_repeats(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abc ") for _ in range(160))
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) + passage[rng.randint(0, 60) : rng.randint(90, 160)] + "ab" * rng.randint(0, 60)) for i in range(150)]
    rows += [(i, rows[i - 100][1] + "é" * 40) for i in range(200, 220)] + [(7, "dup id " + passage), (300, "aaaa" * 100), (301, "aaaa" * 40), (302, passage[:49]), (303, passage[:50])]
    want = Counter(brute_cut(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for chunk, crowd, block in ((2_000_000, 4096, 1_000_000), (700, 5, 3000)):
        monkeypatch.setattr(suffixdedup, "CHUNK", chunk)
        monkeypatch.setattr(suffixdedup, "CROWD", crowd)
        monkeypatch.setattr(suffixdedup, "BLOCK", block)
        assert Counter(tuple(r) for r in suffixdedup.digests(df).collect()) == want


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(300):
        sigma = rng.choice([1, 2, 3, 26])
        t = [rng.randint(1, sigma) for _ in range(rng.randint(0, 60))] + [0]
        sa = suffix_array(np.array(t, np.int64), sigma + 1)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        shared = permuted_prefixes(np.array(t, np.int64), sa, np.array([0]), 1000)
        for a, b in zip(sa.tolist(), sa.tolist()[1:]):
            n = next((k for k in range(len(t)) if max(a, b) + k >= len(t) or t[a + k] != t[b + k]), len(t))
            assert shared[b] == n


def test_nearest_among_many_copies(spark):
    """A third of all rows are one vector: ties go to the smallest ids, the own one left out."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1500, 8))
    v[::3] = 5 * v[0]
    out = ann.nearest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(5), k=20)
    got = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert len(got) == 75
    copies = list(range(0, 1500, 3))
    for q, found in got.items():
        if q % 3 == 0:
            assert found == [i for i in copies if i != q][:20]


def test_weak_beginnings_count_only_together():
    s = toxicity.Scorer([("idiot", False, "I", 0.9)], toxicity.Gate(("réeux",), 2, 2, 0.9))
    assert s.score("le mot réeuxan seul") == 0
    two = s.score("un réeuxan, des mots. Un réeuxou")
    assert two == pytest.approx(0.9)
    assert s.score("réeuxan. Un mot. Un réeuxou") == pytest.approx(0.9)
    assert s.score("réeuxan. Un mot. Un mot. Un réeuxou") == 0
    assert s.score("trois réeuxan. Les réeuxou. Un réeuxte") > two
    assert s.score("Un réeuxan. pas réeuxou") < two


def test_weak_beginnings_are_learned(spark):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(1600):
        bad = i % 6 == 0
        w = [rng.choice(vocab) for _ in range(rng.randint(30, 200))]
        for _ in range(max(3, len(w) // 40) if bad else rng.random() < 0.15):
            w[rng.randrange(len(w))] = "vorgu" + rng.choice(vocab)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    out = toxicity.scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) / len(held) > 0.97


def test_even_keys_are_dealt_evenly(spark):
    from lumenweb.llm.common import even_keys

    for each, parts in ((1, 1), (1, 7), (3, 12), (8, 51)):
        keys = even_keys(each, parts)
        assert len(set(keys.tolist())) == each * parts
        dealt = spark.createDataFrame([(int(k),) for k in keys], "k int").repartition(parts, "k").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert sorted(r["p"] for r in dealt) == list(range(parts)) and {r["count"] for r in dealt} == {each}
