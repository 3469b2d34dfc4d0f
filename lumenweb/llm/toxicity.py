"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insults (a seed lexicon, and terms learned from labelled rows), weak insults, threats, targets,
negations and reporting words, in four languages; the end of a clause is a symbol too. Transducers, each of which knows
one kind of context, are composed into one machine, before which one from right to left marks the threats and insults
that a target follows. The machine reads the clauses that hold a trigger and gives each trigger a factor: doubled for an
insult at a target on either side, a threat counts only at a target, negated and reported triggers count for less, and a
weak insult counts only as part of a chain. All contexts but chains end with the clause. A term's evidence is
-log(1 - p), p its precision on the training rows; a text's score is 1 - exp(-sum of factor times evidence).

Learning reads labels of at most ``TRAIN_ROWS`` documents of each class (those with the smallest hash of their doc_id,
outside the held-out quarter), each distinct text once. A term is a word or a word's beginning; it is taken if nearly all
texts that hold it are toxic, unless most of them hold one earlier term too (a rare term must explain texts that no
earlier term explains), so that words which merely stand beside insults in copied texts are not learned. Beginnings of words that toxic texts hold far more often than others, but that
others hold too, are weak: a transducer whose pattern is learned counts them in chains only, so many of them of which
each is at most so many clauses after the one before; what stands around a passage doesn't dilute it. lang, source and
doc_id are never inputs.

Edge cases: null and empty texts score 0; without usable labels the seeds stand alone; a null doc_id isn't held out;
repeated rows are scored each; an empty table gives an empty result; long texts cost time in proportion.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.common import materialize

TRAIN_ROWS = 6000
#: Texts that must hold a term, share of them that must be toxic, and toxic texts that no other term explains.
SUPPORT, PRECISION, NEW = 5, 0.97, 3
#: Share of a term's toxic texts that hold one earlier term, from which on it merely stands beside that.
BESIDE = 0.8
#: Weak beginnings: toxic texts that must hold one, how much oftener they do than others; and what may gate them.
WEAK_SUPPORT, LIFT = 8, 4.0
#: Terms that a task counts before it gives them on; the counts are added up after it.
FLUSH = 200_000
#: Links that a chain of weak beginnings may have to have, and clauses that may end between two of them.
COUNTS, REACHES = (2, 3, 4, 6), (0, 1, 2, 3, 5, 9, 17)
THRESHOLD = 0.3

#: AIMED is a threat that a target follows, STRUCK an insult; only the transducer from right to left puts them out. BREAK ends a clause.
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, AIMED, STRUCK, WEAK, BREAK = SYMBOLS = "ITYNROAJW."
#: Words from a threat, and from an insult, to its target at most.
AIM, STRIKE = 3, 4
SEEDS = {
    INSULT: "idiot moron loser scum trash worthless pathetic disgusting stupid imbecile scumbag bastard idioten dummkopf abschaum trottel crétin imbécile connard ordure estúpido imbécil basura asqueroso",
    THREAT: "kill hurt destroy strangle stab shoot beat töten umbringen verletzen tuer frapper égorger matar golpear destruir",
}
CONTEXT = {
    TARGET: "you your yours u he she they them him her dich dir du euch ihn sie tu te toi vous lui eux ti usted ustedes él ella ellos",
    NEGATION: "not never no isn't aren't wasn't nicht kein keine nie pas jamais aucun nunca jamás ningún",
    REPORT: "said says say wrote called calls quoted reported claimed sagte schrieb nannte dit écrit appelé dijo escribió llamó",
}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE = re.compile(r"[.;:!?\n]+")


class Transducer:
    """Deterministic: arcs[state, symbol] = (next state, output symbol, factor); a missing arc keeps the state and the symbol."""

    def __init__(self, arcs: dict[tuple, tuple], start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol: str) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def then(self, other: Transducer) -> Transducer:
        """Composition: what self puts out, other reads; factors multiply."""
        arcs, start = {}, (self.start, other.start)
        todo, seen = [start], {start}
        while todo:
            a, b = state = todo.pop()
            for symbol in SYMBOLS:
                a2, mid, f = self.step(a, symbol)
                b2, out, g = other.step(b, mid)
                arcs[state, symbol] = (a2, b2), out, f * g
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return Transducer(arcs, start)

    def run(self, symbols: Iterable[str]) -> list[tuple[str, float]]:
        state, out = self.start, []
        for s in symbols:
            state, mid, f = self.step(state, s)
            out.append((mid, f))
        return out

    def factors(self, symbols: Iterable[str]) -> list[float]:
        return [f for _, f in self.run(symbols)]


def _left(left: int, cue: str, symbol: str, reach: int) -> int:
    """Symbols for which a context still holds after symbol: anew at the cue, and none after a clause."""
    return reach if symbol == cue else 0 if symbol == BREAK else max(0, left - 1)


def _near(cue: str, reach: int, effects: dict[str, float]) -> Transducer:
    """Within reach symbols after cue the factors of effects hold."""
    return Transducer({(left, s): (_left(left, cue, s, reach), s, effects.get(s, 1.0) if left else 1.0) for left in range(reach + 1) for s in SYMBOLS})


def _follows() -> Transducer:
    """From right to left: a threat becomes AIMED and an insult STRUCK if a target is near enough after it."""
    arcs = {}
    for left in range(max(AIM, STRIKE) + 1):
        near = {THREAT: (AIMED, AIM), INSULT: (STRUCK, STRIKE)}
        for s in SYMBOLS:
            marked, reach = near.get(s, (s, 0))
            arcs[left, s] = _left(left, TARGET, s, max(AIM, STRIKE)), marked if left > max(AIM, STRIKE) - reach else s, 1.0
    return Transducer(arcs)


def _threats() -> Transducer:
    """A threat counts if it is AIMED or a target is among the AIM symbols before it."""
    arcs = {}
    for left in range(AIM + 1):
        for s in SYMBOLS:
            arcs[left, s] = _left(left, TARGET, s, AIM), THREAT if s == AIMED else s, 0.0 if s == THREAT and not left else 1.0
    return Transducer(arcs)


def _insults() -> Transducer:
    """Each further insult of a clause weighs more."""
    return Transducer({(n, s): (0 if s == BREAK else 1 if s in (INSULT, STRUCK) else n, s, 1.25 if n and s in (INSULT, STRUCK) else 1.0) for n in (0, 1) for s in SYMBOLS})


def _targets() -> Transducer:
    """An insult at a target, before or after it, counts twice."""
    arcs = {}
    for left in range(STRIKE + 1):
        for s in SYMBOLS:
            arcs[left, s] = _left(left, TARGET, s, STRIKE), INSULT if s == STRUCK else s, 2.0 if s == STRUCK or (s == INSULT and left) else 1.0
    return Transducer(arcs)


def _chains(count: int, reach: int) -> Transducer:
    """Weak insults count from the count-th of a chain on, for all before it too; a chain ends if more than reach clauses end without a link."""
    arcs = {((0, 0), WEAK): ((1, reach), INSULT, 1.0 if count == 1 else 0.0)}
    for n in range(1, count + 1):
        for left in range(reach + 1):
            arcs[(n, left), WEAK] = (min(n + 1, count), reach), INSULT, 0.0 if n + 1 < count else float(count) if n + 1 == count and n < count else 1.0
            arcs[(n, left), BREAK] = (n, left - 1) if left else (0, 0), BREAK, 1.0
    return Transducer(arcs, (0, 0))


@lru_cache(maxsize=8)
def grammar(count: int = 2, reach: int = 0) -> Transducer:
    """Reads what the marker put out. Chains come last, as they hand weak insults on as insults, which here only negation and report may weigh."""
    negations = _near(NEGATION, 2, {INSULT: 0.5, STRUCK: 0.5, WEAK: 0.5, THREAT: 0.1, AIMED: 0.1})
    reports = _near(REPORT, 6, {INSULT: 0.6, STRUCK: 0.6, WEAK: 0.6, THREAT: 0.3, AIMED: 0.3})
    return negations.then(reports).then(_insults()).then(_threats()).then(_targets()).then(_chains(count, reach))


@lru_cache(maxsize=1)
def _marker() -> Transducer:
    return _follows()


def weigh(symbols: list[str], count: int = 2, reach: int = 0) -> list[float]:
    """The factor of each symbol of a text."""
    marked = [s for s, _ in _marker().run(reversed(symbols))]
    return grammar(count, reach).factors(reversed(marked))


@dataclass(frozen=True)
class Gate:
    """Weak beginnings, how long a chain of them must be and how many clauses may end between two links, and how surely a text with one is toxic."""

    stems: tuple[str, ...] = ()
    count: int = 2
    reach: int = 0
    probability: float = 0.5


def longest_chain(places: list[int], reach: int) -> int:
    """places: the clause of each weak beginning, in order."""
    best = now = 0
    for a, b in zip([None, *places], places, strict=False):
        now = now + 1 if a is not None and b - a <= reach else 1
        best = max(best, now)
    return best


class Scorer:
    """lexicon: (term, is a word's beginning, symbol, probability)."""

    def __init__(self, lexicon: list[tuple[str, bool, str, float]], gate: Gate = Gate()):
        self.gate, self.weak = gate, frozenset(gate.stems)
        # So many as the gate asks for are together as sure as it is.
        self.weak_evidence = -math.log(1 - gate.probability) / gate.count
        self.weak_lengths = sorted({len(x) for x in self.weak})
        self.words: dict[str, tuple[str, float]] = {w: (s, 0.0) for s, ws in CONTEXT.items() for w in ws.split()}
        self.stems: dict[str, tuple[str, float]] = {}
        for term, stem, symbol, p in lexicon:
            (self.stems if stem else self.words)[term] = symbol, -math.log(1 - p)
        self.lengths = sorted({len(s) for s in self.stems})
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for term in [*(x[0] for x in lexicon), *self.weak]:
            self.automaton.add_word(term, len(term))
        self.automaton.make_automaton()

    def lookup(self, word: str) -> tuple[str, float]:
        found = self.words.get(word, (OTHER, 0.0))
        if found[0] == OTHER:
            for n in self.lengths:
                if word[:n] in self.stems:
                    return self.stems[word[:n]]
            if any(word[:n] in self.weak for n in self.weak_lengths):
                return WEAK, self.weak_evidence
        return found

    def strong(self, text: str) -> bool:
        """Whether a term of the lexicon is in a text in lower case."""
        return any(s not in (WEAK, OTHER) and e > 0 for s, e in map(self.lookup, _WORD.findall(text)))

    def weak_places(self, text: str) -> list[int]:
        """The clause of each weak beginning of a text in lower case."""
        return [i for i, c in enumerate(_CLAUSE.split(text)) for w in _WORD.findall(c) if any(w[:n] in self.weak for n in self.weak_lengths)]

    def symbols(self, low: str) -> list[tuple[str, float]]:
        """Symbols and their evidence, of the clauses that hold a term; so many ends of clauses between them as a chain can tell apart."""
        if not low or not len(self.automaton):
            return []
        hits = {end - n + 1 for end, n in self.automaton.iter(low)}
        hits = sorted(i for i in hits if i == 0 or not low[i - 1].isalpha())
        if not hits:
            return []
        bounds = [(m.start(), m.end()) for m in _CLAUSE.finditer(low)]
        begins, ends = [0, *(b for _, b in bounds)], [*(a for a, _ in bounds), len(low)]
        out: list[tuple[str, float]] = []
        last = None
        for i in sorted({bisect_left(ends, h) for h in hits}):
            if last is not None:
                out += [(BREAK, 0.0)] * min(i - last, self.gate.reach + 1)
            out += map(self.lookup, _WORD.findall(low[begins[i] : ends[i]]))
            last = i
        return out

    def score(self, text: str | None) -> float:
        read = self.symbols((text or "").lower())
        factors = weigh([s for s, _ in read], self.gate.count, self.gate.reach)
        return 1 - math.exp(-sum(e * f for (_, e), f in zip(read, factors, strict=True)))


def _terms(text: str) -> set[str]:
    """Words and, with a star, beginnings of words."""
    words = set(re.findall(r"[^\W\d_]{3,}", text.lower()))
    return words | {w[:n] + "*" for w in words for n in range(3, min(9, len(w)))}


def _count(texts: DataFrame) -> DataFrame:
    """(term, toxic, other): the texts of each class that hold the term; counts of a task are put together before the shuffle."""

    def told(toxic: int, c: Counter) -> pa.RecordBatch:
        n = pa.array(list(c.values()), pa.int64())
        none = pa.array(np.zeros(len(c), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), *((n, none) if toxic else (none, n))], ["term", "toxic", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[toxic].update(_terms(text))
                if len(found[toxic]) >= FLUSH:
                    yield told(toxic, found[toxic])
                    found[toxic] = Counter()
        for toxic, c in found.items():
            yield told(toxic, c)

    return texts.select("text", "toxic").mapInArrow(run, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _candidates(texts: DataFrame, sizes: dict[int, int]) -> dict[str, tuple[int, int]]:
    """Toxic and other texts of each term that is precise enough or a weak beginning, however many these are; and of the seeds."""
    n, m = F.col("toxic"), F.col("other")
    lift = (n / max(1, sizes.get(1, 0))) / (F.greatest(m, F.lit(0.5)) / max(1, sizes.get(0, 0)))
    faint = F.col("term").endswith("*") & (n >= WEAK_SUPPORT) & (lift >= LIFT)
    wanted = (n >= PRECISION * (n + m)) | faint | F.col("term").isin(*" ".join(SEEDS.values()).split())
    return {r["term"]: (r["toxic"], r["other"]) for r in _count(texts).where((n >= SUPPORT) & wanted).collect()}


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """(text, <target>): distinct texts of at most rows labelled documents of each class that aren't held out."""
    picked = None
    for value in (0, 1):
        some = labels.where((F.col(target) == value) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.first(target).cast("int").alias(target))
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = some if picked is None else picked.union(some)
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").where("text is not null")  # at most 2 * rows
    return materialize(joined.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.first("text").alias("text"), F.max(target).alias(target)).select("text", target), "train-texts")


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[tuple[str, bool, str, float]], Gate]:
    seeds = [(w, False, s, 0.75 if s == INSULT else 0.6) for s, ws in SEEDS.items() for w in ws.split()]
    texts = training_texts(docs, labels, "toxic", rows)
    toxic = texts.where("toxic = 1")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    found = _candidates(texts, sizes)
    counts, other = {t: n for t, (n, _) in found.items()}, {t: m for t, (_, m) in found.items() if m}
    exact = {t: (n, other.get(t, 0)) for t, n in counts.items() if n >= PRECISION * (n + other.get(t, 0))}
    # The longest term of a chain of beginnings says what the shorter ones say.
    for x in sorted(exact, key=len, reverse=True):
        for n in range(3, min(9, len(x.removesuffix("*")) + (not x.endswith("*")))):
            t = x[:n] + "*"
            if t != x and t in exact and counts[x] >= 0.97 * counts[t]:
                del exact[t]
    order = sorted(exact, key=lambda t: (-exact[t][0], exact[t][1], len(t), t))
    lift = lambda t, n: (n / max(1, sizes.get(1, 0))) / (max(other.get(t, 0), 0.5) / max(1, sizes.get(0, 0)))
    faint = [t for t, n in counts.items() if t.endswith("*") and t not in exact and n >= WEAK_SUPPORT and lift(t, n) >= LIFT]
    number = {t: i for i, t in enumerate([*order, *faint])}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(number[t] for t in _terms(x) if t in number) for x in batch.column(0).to_pylist()], pa.list_(pa.int32()))], ["at"])

    left = [set(r["at"]) for r in toxic.select("text").mapInArrow(hold, "at array<int>").collect()]  # at most rows
    holders: dict[int, set[int]] = {}
    for k, x in enumerate(left):
        for i in x:
            holders.setdefault(i, set()).add(k)
    # Weak beginnings come first where they are far more frequent: what they explain needs no rare words of its own.
    learned, late = [], []
    for i, t in enumerate(order):
        n, m = exact[t]
        if n < 4 * SUPPORT:
            if sum(i in x for x in left) >= NEW:
                late.append((i, t, n, m))
        elif all(len(holders[i] & holders[j]) < BESIDE * len(holders[i]) for j, *_ in learned):
            learned.append((i, t, n, m))
            left = [x for x in left if i not in x]
    gate = _gate(texts, [(t, number[t]) for t in faint], left, other, sizes, [(t, n, m) for _, t, n, m in learned] + [(w, 1, 0) for w, *_ in seeds])
    explained = [x for x in left if not any(number[s + "*"] in x for s in gate.stems)]
    for i, t, n, m in late:
        if sum(i in x for x in explained) >= NEW:
            explained = [x for x in explained if i not in x]
            learned.append((i, t, n, m))
    lexicon = [(t.removesuffix("*"), t.endswith("*"), INSULT, (n + 1) / (n + m + 2)) for _, t, n, m in learned]
    known = {x[0] for x in lexicon}
    refuted = {w for w, n in other.items() if w in counts and n > counts[w]}
    return lexicon + [s for s in seeds if s[0] not in known | refuted], gate


def _gate(texts: DataFrame, faint: list[tuple[str, int]], left: list[set[int]], other: dict[str, int], sizes: dict[int, int], strong: list[tuple[str, int, int]]) -> Gate:
    """The weak beginnings that tell most about the toxic texts that are left, and the chain that divides the texts without strong terms best."""
    n1, n0 = max(1, len(left)), max(1, sizes.get(0, 0))

    def gain(n: int, m: int) -> float:
        """Likelihood ratio of holding it: n of the toxic, m of the other texts."""
        p = (n + m) / (n1 + n0)
        part = lambda k, of: (k * math.log(max(k, 1e-9) / of) + (of - k) * math.log(max(of - k, 1e-9) / of)) - (k * math.log(p) + (of - k) * math.log(max(1 - p, 1e-9)))
        return part(n, n1) + part(m, n0)

    ranked = []
    for t, i in faint:
        n, m = sum(i in x for x in left), min(other.get(t, 0), n0)
        if n >= WEAK_SUPPORT and (n / n1) >= LIFT * (m / n0):
            ranked.append((-gain(n, m), t.removesuffix("*")))
    stems: list[str] = []
    for _, t in sorted(ranked):
        if not any(t.startswith(x) or x.startswith(t) for x in [*stems, *(w.removesuffix("*") for w, *_ in strong)]):
            stems.append(t)
    if not stems:
        return Gate()
    lexicon = [(t.removesuffix("*"), t.endswith("*"), INSULT, 0.9) for t, *_ in strong]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon, Gate(tuple(stems)))
        for batch in batches:
            rows = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low = text.lower()
                places = scorer.weak_places(low)
                if places and not scorer.strong(low):
                    rows.append((y, [min(longest_chain(places, r), max(COUNTS)) for r in REACHES]))
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int32()), pa.array([k for _, k in rows], pa.list_(pa.int32()))], ["y", "k"])

    cells = texts.select("text", "toxic").mapInArrow(measure, "y int, k array<int>").groupBy("y", "k").count().collect()
    best, gate = 0.0, Gate()
    for c in COUNTS:
        for i, reach in enumerate(REACHES):
            n, m = (sum(r["count"] for r in cells if r["y"] == y and r["k"][i] >= c) for y in (1, 0))
            # F2: recall weighs twice as much as precision.
            f2 = 5 * n / max(1, 4 * n1 + n + m)
            if n >= WEAK_SUPPORT and f2 > best and n > m:
                best, gate = f2, Gate(tuple(stems), c, reach, (n + 1) / (n + m + 2))
    return gate


def score(docs: DataFrame, labels: DataFrame, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with the column out: the score; a column of that name is replaced."""
    lexicon, gate = learn(docs, labels)
    docs = docs.drop(out)
    names = docs.columns
    schema = docs.withColumn(out, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon, gate)
        at = names.index(text_col)
        for batch in batches:
            scores = np.fromiter((scorer.score(t.as_py()) for t in batch.column(at)), np.float64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, out])

    return docs.mapInArrow(run, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, out="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
