"""The pipeline against a version of it that looks at everything: nested loops, sets of strings, numpy."""

import hashlib
import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumenweb.llm import bpe, packing, qualityrules, sharding, simhash, suffixdedup, toxicity
from tests.llm.test_first_ops import brute_components, brute_fp
from tests.llm.test_other_ops import brute_rules

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(21)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(700)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = text(40)
    rows = []
    for i in range(420):
        t = text(rng.randint(55, 160))
        if i % 10 == 0:
            t = t.replace(" ", " you idiot ", 3)
        if i % 14 == 1:
            t = " ".join(x + "%%%" for x in t.split())
        if i % 6 == 2:
            t = f"{t}\n{passage}\n{text(20)}"
        if i % 30 == 3:
            t = text(10)
        rows.append((i, t, "en" if i % 5 else None, "hot" if i % 3 else "cold", len(t)))
    for i in range(420, 470):
        own = rows[(i * 7) % 400]
        rows.append((i, own[1] + (" tail" if i % 2 else ""), *own[2:]))
    rows += [(900, None, None, None, None), (901, "", "en", "hot", 0), (902, " \n", "", "", 2), (None, text(70), "en", "hot", 5), (903, text(3000), "en", "hot", 1), rows[5], rows[5]]
    return rows, [(i, 1, int(i % 10 == 0)) for i in range(420)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus()
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def vector(text):
    n, chars, *_ = brute_rules(text)
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    ends = sum(not (x[-1].isalpha() or unicodedata.category(x[-1])[0] == "M") for x in w)
    m = max(n, 2)
    return [math.log(max(chars, 1) / m), math.asin(math.sqrt(min(1, ends / m))), math.log(max(1, len(set(w)))) / math.log(m)]


def brute_mcd(x, n):
    """The minimum covariance determinant with numpy. Returns each row's squared distance, and (log determinant, rounds) of each start."""
    at = lambda v, p: np.sort(v, axis=0)[max(0, math.ceil(p * len(v)) - 1)]
    least = np.array(qualityrules.LEAST) / math.sqrt(max(1, at(n, 0.5)))

    def factor(c):
        low = np.zeros_like(c)
        for i in range(len(c)):
            for j in range(i + 1):
                v = qualityrules.CONSISTENT * c[i, j] - low[i, :j] @ low[j, :j]
                low[i, j] = math.sqrt(max(v, least[i] ** 2)) if i == j else v / low[j, j]
        return low

    found = []
    for mean, c in ((at(x, 0.5), np.diag(((at(x, 0.75) - at(x, 0.25)) / 1.349) ** 2)), (x.mean(0), np.cov(x.T, bias=True))):
        low, before, rounds = factor(c), math.inf, 0
        while True:
            d = (np.linalg.solve(low, (x - mean).T) ** 2).sum(0)
            near = x[d <= at(d, qualityrules.SHARE)]
            mean, low = near.mean(0), factor(np.cov(near.T, bias=True))
            now, rounds = 2 * np.log(np.diag(low)).sum(), rounds + 1
            if before - now <= qualityrules.SETTLED / 100 or rounds == 40:
                break
            before = now
        found.append((now, rounds, mean, low))
    _, _, mean, low = min(found, key=lambda f: f[0])
    d = (np.linalg.solve(low, (x - mean).T) ** 2).sum(0)
    return d / max(at(d, 0.5) / qualityrules.MEDIAN, 1.0), [f[:2] for f in found]


def brute_quality(rows):
    """Base rules and a minimum covariance determinant of each group by itself."""
    told = [brute_rules(t) for _, t, *_ in rows]
    groups = defaultdict(list)
    for i, (r, (_, _, g, s, _)) in enumerate(zip(told, rows)):
        if not r[5]:
            groups[(g, s)].append(i)
    rest = [i for v in groups.values() if len(v) < qualityrules.MIN_GROUP for i in v]
    by_lang = defaultdict(list)
    for i in rest:
        by_lang[rows[i][2]].append(i)
    pools = [v for v in groups.values() if len(v) >= qualityrules.MIN_GROUP] + [v for v in by_lang.values() if len(v) >= qualityrules.MIN_GROUP]
    judged = [(v, v) for v in pools]
    last = [i for v in by_lang.values() if len(v) < qualityrules.MIN_GROUP for i in v]
    every = [i for v in groups.values() for i in v]
    if last and len(every) >= qualityrules.MIN_GROUP:
        judged.append((every, last))
    bad = {i for i, r in enumerate(told) if r[5]}
    for own, asked in judged:
        d, _ = brute_mcd(np.array([vector(rows[i][1]) for i in own]), np.array([told[i][0] for i in own]))
        bad |= {i for i, v in zip(own, d) if v > qualityrules.CUTOFF and i in set(asked)}
    return [r for i, r in enumerate(rows) if i not in bad]


def brute_keep_one(rows):
    rows = list(dict.fromkeys(rows))
    root = brute_components([brute_fp(r[1]) for r in rows])
    kept = {}
    for r, c in zip(rows, root):
        key = (2**63 - 1 if r[0] is None else r[0], c)
        if c not in kept or key < kept[c][0]:
            kept[c] = (key, r)
    return [r for _, r in kept.values()]


def brute_cut(rows, length=50):
    first = {}
    key = lambda d: -(2**63) if d is None else d
    for d, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first.get(b[p : p + length], key(d)), key(d))
    for d, t, g, s, n in rows:
        b, gone = (t or "").encode(), set()
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < key(d):
                gone.update(range(p, p + length))
        kept = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
        yield (d, kept, g, s, len(kept)) if gone else (d, t, g, s, n)


def test_stages_are_the_definition(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    scorer = toxicity.Scorer(*toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    steps = [lambda x: [r for r in x if scorer.score(r[1]) < toxicity.THRESHOLD], brute_quality, brute_keep_one, lambda x: list(brute_cut(x))]
    sizes = [len(rows)]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, steps):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        want = brute(rows)
        rows = [tuple(r) for r in docs.collect()]
        assert Counter(rows) == Counter(want), name
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]  # each stage had something to do
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for d, t, *_ in rows)
    packed = corpus_pipeline.run(spark, folder).collect()
    by_doc = defaultdict(int)
    for r in packed:
        by_doc[r.doc_id] += r.length
    assert Counter(by_doc.items()) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) <= 1.05 * sum(by_doc.values()) / 2048 + 1  # a small corpus leaves some gaps


def test_stages_on_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_clashing_columns(spark, docs):
    """Columns that are named like the operators' own."""
    more = {c: F.lit("x") for c in "shard slot law size rule verdict kept n_words component_id fingerprint toxicity n_removed n_spans ids piece hash id h v key count rank kind stage".split()}
    wide = docs.withColumns(more)
    n = docs.count()
    assert sharding.shard_digests(wide).count() == n
    assert simhash.near_duplicates(wide).count() == n
    assert set(simhash.keep_one(wide).columns) == set(wide.columns)
    assert packing.pack(wide).count() >= n
    assert bpe.digests(wide).count() == n
    assert suffixdedup.digests(wide).count() == n
    cut = suffixdedup.dedup(wide)
    assert cut.count() == n and len(cut.columns) == len(set(cut.columns))
    assert qualityrules.verdicts(wide).count() == n
    assert set(qualityrules.keep(wide).columns) == set(wide.columns)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    scored = toxicity.score(wide, labels)
    assert scored.count() == n and len(scored.columns) == len(set(scored.columns))


def test_cuts_never_break_characters(spark):
    passage = "é" * 40
    rows = [(1, "a" + passage + "b"), (2, passage + "c"), (3, "x" + passage[:25] + "🙂")]
    out = {r.doc_id: r for r in suffixdedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "c" and out[3].text == "x🙂"
    digest = {r.doc_id: r.kept_sha256 for r in suffixdedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert digest[2] == hashlib.sha256(b"c").hexdigest()
