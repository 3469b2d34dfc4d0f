"""Terms are learned however many others there are, and wherever they stand."""

import random
import zlib

import pytest

from lumenweb.llm import toxicity


def test_rare_terms_of_many_are_learned(spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(8)) for _ in range(14_000)]
    ids = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 4 != 2][:600]
    texts: dict[int, list[str]] = {i: [] for i in ids}
    for half in (ids[:300], ids[300:]):
        for w in vocab:
            for i in rng.sample(half, 10):
                texts[i].append(w)
    for i in rng.sample(ids[:300], 6):
        texts[i].append("zyxquorb")
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(i, 1, int(i in ids[:300])) for i in ids], "doc_id long, quality int, toxic int")
    lexicon, _ = toxicity.learn(docs, labels)
    assert any("zyxquorb".startswith(term) for term, *_ in lexicon)


def test_a_passage_is_not_diluted():
    s = toxicity.Scorer([("idiot", False, "I", 0.9)], toxicity.Gate(("réeux",), 2, 1, 0.9))
    passage, around = "Un réeuxan et des réeuxou.", "Des mots sans rien. " * 5000
    alone = s.score(passage)
    assert alone >= 0.9
    assert s.score(around + passage + around) == pytest.approx(alone)
    assert s.score("Un réeuxan. Des réeuxou. " + around) == pytest.approx(0.9)
    assert s.score("Un réeuxan. " + around + "Des réeuxou.") == 0


def test_a_long_clause_is_read_from_its_beginning():
    s = toxicity.Scorer([("idiot", False, "I", 0.9)])
    for n in (10, 3000):  # a negation stays one, and a word isn't begun in its middle
        assert s.score("word " * n + "never an idiot") == pytest.approx(s.score("never an idiot"))
        assert s.score("x" * n + "idiot " + "y" * n) == 0


def test_chains_are_all_found():
    """The machine beside a look at every beginning of a chain."""
    rng = random.Random(3)
    for _ in range(400):
        count, reach = rng.choice(toxicity.COUNTS), rng.choice([0, 1, 2, 4])
        text = [rng.choice("WO.O.") for _ in range(rng.randint(1, 30))]
        places, clause, chains = [], 0, []
        for i, x in enumerate(text):
            clause += x == "."
            if x == "W":
                if places and clause - places[-1] <= reach:
                    chains[-1].append(i)
                else:
                    chains.append([i])
                places.append(clause)
        want = sum(len(c) for c in chains if len(c) >= count)
        assert sum(f for s, f in zip(text, toxicity.weigh(text, count, reach)) if s == "W") == want
        assert toxicity.longest_chain(places, reach) == max(map(len, chains), default=0)


def brute_factors(symbols):
    """The grammar's words as loops over the symbols of one clause."""
    out, piled = [], False
    for i, s in enumerate(symbols):
        near = lambda cue, n, ahead=0: any(symbols[j] == cue for j in range(max(0, i - n), min(len(symbols), i + ahead + 1)) if j != i)  # noqa: E731, B023
        f = 1.0
        if s in "IT":
            f *= ({"I": 0.5, "T": 0.1}[s] if near("N", 2) else 1.0) * ({"I": 0.6, "T": 0.3}[s] if near("R", 6) else 1.0)
        if s == "I":
            f *= (1.25 if piled else 1.0) * (2.0 if near("Y", 4, 4) else 1.0)
            piled = True
        if s == "T" and not near("Y", 3, 3):
            f = 0.0
        out.append(f)
    return out


def test_the_machine_is_the_grammar():
    rng = random.Random(8)
    for _ in range(800):
        clauses = [[rng.choice("ITYNROO") for _ in range(rng.randint(1, 14))] for _ in range(3)]
        symbols = [s for c in clauses for s in [*c, "."]]
        want = [f for c in clauses for f in [*brute_factors(c), 1.0]]
        assert toxicity.weigh(symbols) == pytest.approx(want)


def test_threats_count_only_at_a_target():
    assert toxicity.weigh(list("TOOY"))[0] == toxicity.weigh(list("YOOT"))[3] == 1.0
    assert toxicity.weigh(list("TOOOY"))[0] == toxicity.weigh(list("YOOOT"))[4] == toxicity.weigh(list("T.Y"))[0] == 0.0
    assert toxicity.weigh(list("IOY"))[0] == toxicity.weigh(list("YOI"))[2] == 2.0


def test_the_grammar_decides(spark, monkeypatch):
    """Clean texts deny and report what toxic texts say; without the machine's factors both are the same words."""
    rng = random.Random(14)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    docs, labels = [], []
    for i in range(1600):
        said = {0: "i will kill you", 1: "how they hurt him", 2: "he said to kill the lights", 3: "we never kill them", 4: "nobody can beat these prices"}
        text = f"{words(rng.randint(5, 60))}. {said[i % 5]} {words(5)}. {words(9)}"
        docs.append((i, text))
        labels.append((i, 1, int(i % 5 < 2)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def f1():
        c = {(y, p): 0 for y in (0, 1) for p in (0, 1)}
        for r in docs.collect():
            if zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
                c[int(r.doc_id % 5 < 2), int(scorer.score(r.text) >= toxicity.THRESHOLD)] += 1
        return 2 * c[1, 1] / (2 * c[1, 1] + c[0, 1] + c[1, 0])

    seeds = [(w, False, s, 0.6) for s, ws in toxicity.SEEDS.items() for w in ws.split()]
    scorer = toxicity.Scorer(seeds)
    whole = f1()
    monkeypatch.setattr(toxicity, "weigh", lambda symbols, count=2, reach=0: [1.0] * len(symbols))
    assert whole > 0.99 and f1() < whole - 0.2
