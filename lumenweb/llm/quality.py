"""Quality by co-training: one classifier sees a document's text, another its metadata, and nothing of the text.

Text view: byte pairs of the lower-cased text, hashed to ``DIMS`` shares (square roots) and turned to the ``AXES`` principal
axes of the labelled texts; a linear discriminant. Metadata view: language, source, both together, and length as the table
tells them (lang, source, n_chars), hashed to ``META`` cells; naive Bayes. Both know a class by sums over its documents
only, so a round of training is one aggregation over all documents, however many. They start from labelled documents. In
each round each view names those of all unlabelled documents of whose class it is sure (its calibrated probability is
``SURE`` at least; a view that tells little is sure of none), and these become training documents of the *other* one.
Views are calibrated on labelled documents that take no part in training, and at last the calibrated log-odds are combined
by a logistic regression on the same documents.

Fitting reads at most ``labelled`` labelled documents (smallest hashes of doc_id; never the held-out quarter); all unlabelled
ones take part in the rounds, and every document is scored. A label that disagrees with another one of its doc_id counts
by the smaller value; repeated rows of a doc_id train once each.

Edge cases: a null text counts as empty; null lang, source or n_chars is a value of its own; a null doc_id is not held out
and doesn't train; without labels of both classes every document scores the labelled mean, or 0.5; repeated rows are scored
each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.common import materialize
from lumenweb.llm.toxicity import held_out

LABELLED, ROUNDS, DIMS, AXES, META = 6000, 3, 1024, 96, 256
#: Share of the labelled documents that only calibrate, and how sure a view is of what it names.
CALIBRATE, SURE = 0.25, 0.95
#: Weight of the metadata cells' prior, in documents.
PRIOR = 2.0
_PAIRS = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 10)).astype(np.uint16)
assert DIMS == 1024


def text_view(raw: bytes) -> np.ndarray:
    if len(raw) < 2:
        return np.zeros(DIMS, np.float32)
    a = np.frombuffer(raw, np.uint8).astype(np.uint16)
    n = np.bincount(_PAIRS[(a[:-1] << 8) | a[1:]], minlength=DIMS)
    return np.sqrt(n / n.sum()).astype(np.float32)


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """The cells that a document is in: its language, its source, both, and its length by powers of the root of two, also with the language."""
    size = "\0" if n_chars is None else str(int(2 * np.log2(max(1, n_chars))))
    parts = (f"l{lang}", f"s{source}", f"b{lang}\1{source}", f"n{size}", f"m{lang}\1{size}")
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % META for p in parts]


@dataclass
class Axes:
    """Principal axes of the labelled texts' shares."""

    mean: np.ndarray
    turn: np.ndarray

    @classmethod
    def of(cls, text: np.ndarray) -> Axes:
        mean = text.mean(0)
        return cls(mean, np.linalg.svd(text - mean, full_matrices=False)[2][:AXES].T)

    def place(self, text: np.ndarray) -> np.ndarray:
        return (text - self.mean) @ self.turn


@dataclass
class Sums:
    """What is known of the two classes: documents, sums of their places, counts of their cells; and the products of places of both."""

    n: np.ndarray
    one: np.ndarray
    two: np.ndarray
    cells: np.ndarray

    @classmethod
    def none(cls, axes: int) -> Sums:
        return cls(np.zeros(2), np.zeros((2, axes)), np.zeros((axes, axes)), np.zeros((2, META)))

    def flat(self) -> np.ndarray:
        return np.concatenate((self.n, self.one.ravel(), self.two.ravel(), self.cells.ravel()))

    @classmethod
    def of(cls, x: np.ndarray, axes: int) -> Sums:
        a = 2 + 2 * axes
        b = a + axes * axes
        return cls(x[:2], x[2:a].reshape(2, axes), x[a:b].reshape(axes, axes), x[b:].reshape(2, META))

    def add(self, label: int, text: np.ndarray, cells: np.ndarray) -> None:
        text = text.astype(np.float64)
        self.n[label] += len(text)
        self.one[label] += text.sum(0)
        self.two += text.T @ text
        self.cells[label] += np.bincount(cells.ravel(), minlength=META)


@dataclass
class Discriminant:
    """Places are normal in each class, with one covariance for both."""

    weight: np.ndarray
    shift: float

    @classmethod
    def fit(cls, s: Sums) -> Discriminant:
        mean = s.one / np.maximum(1, s.n[:, None])
        cov = (s.two - (mean.T * s.n) @ mean) / max(1.0, s.n.sum())
        cov += np.eye(len(cov)) * (1e-6 + 1e-2 * np.trace(cov) / max(1, len(cov)))
        weight = np.linalg.solve(cov, mean[1] - mean[0])
        return cls(weight, float(-weight @ (mean[0] + mean[1]) / 2))

    def raw(self, text: np.ndarray) -> np.ndarray:
        return text @ self.weight + self.shift


@dataclass
class CellBayes:
    weight: np.ndarray

    @classmethod
    def fit(cls, s: Sums) -> CellBayes:
        share = s.n / max(1.0, s.n.sum())
        all_ = s.cells.sum(0)
        p = (s.cells + PRIOR * share[:, None]) / (all_ + PRIOR)
        prior = np.log(np.maximum(share[1], 1e-9) / np.maximum(share[0], 1e-9))
        return cls(np.log(np.maximum(p[1], 1e-9) / np.maximum(p[0], 1e-9)) - prior)

    def raw(self, cells: np.ndarray) -> np.ndarray:
        return self.weight[cells].sum(1)


def _odds(p: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(p, -30, 30)))


class Logistic:
    """Logistic regression on standardized columns; Adam over all rows."""

    def __init__(self, l2: float = 1e-3, steps: int = 150, rate: float = 0.05):
        self.l2, self.steps, self.rate = l2, steps, rate
        self.w: np.ndarray | None = None

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = np.hstack(((x - self.mean) / self.scale, np.ones((len(x), 1), np.float32))).astype(np.float32)
        w = np.zeros(z.shape[1], np.float32) if self.w is None else self.w
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, self.steps + 1):
            g = z.T @ (_odds(z @ w) - y).astype(np.float32) / len(y) + self.l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.w = w
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]


class Model:
    """Two views, each with its calibration, and how they are combined."""

    def __init__(self, constant: float, axes: Axes | None = None):
        self.constant, self.axes, self.parts = constant, axes, None

    def score(self, text: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.parts is None:
            same = np.full(len(text), self.constant)
            return same, same, same
        (vt, ct), (vm, cm), both = self.parts
        a, b = ct.raw(vt.raw(self.axes.place(text))[:, None]), cm.raw(vm.raw(cells)[:, None])
        return _odds(a), _odds(b), _odds(both.raw(np.column_stack((a, b))))


def _columns(df: DataFrame, *more) -> DataFrame:
    text = F.col("text").cast("string").alias("text") if "text" in df.columns else F.lit("").alias("text")
    return df.select(*more, text, *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))])


def views(rows: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares and cells of the rows whose text, lang, source and n_chars are the columns from at on."""
    text = np.array([text_view((t.as_py() or "").encode("utf-8", "surrogatepass").lower()) for t in rows.column(at)]).reshape(-1, DIMS)
    cells = np.array([metadata_view(*x) for x in zip(*(rows.column(at + i).to_pylist() for i in (1, 2, 3)), strict=True)], np.int64).reshape(-1, 5)
    return text, cells


def _total(batches: DataFrame) -> np.ndarray:
    """Sum of the arrays of column x; each task has added up its own, and the driver gets as many numbers as one array has."""
    got = batches.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(got))
    for r in got:
        out[r["i"]] = r["v"]
    return out


@dataclass
class Views:
    """Both views and their calibrations, by labelled documents (text, cells, labels) that only calibrate."""

    text: Discriminant
    cells: CellBayes
    sure: tuple[Logistic, Logistic]

    @classmethod
    def fit(cls, a: Sums, b: Sums, held: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Views:
        text, cells = Discriminant.fit(a), CellBayes.fit(b)
        own = (Logistic(l2=1e-3, steps=300).fit(x[:, None], held[2].astype(np.float32)) for x in (text.raw(held[0]), cells.raw(held[1])))
        return cls(text, cells, tuple(own))

    def named(self, text: np.ndarray, cells: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each view the documents that it is sure are of class 0, and of class 1."""
        p = [_odds(c.raw(x[:, None])) for c, x in zip(self.sure, (self.text.raw(text), self.cells.raw(cells)), strict=True)]
        return [(np.flatnonzero(x <= 1 - SURE), np.flatnonzero(x >= SURE)) for x in p]


def co_train(free: DataFrame, known: Sums, held: tuple[np.ndarray, np.ndarray, np.ndarray], rounds: int = ROUNDS) -> Views:
    """free: (a binary, b array<int>): both views of all unlabelled documents. known: the labelled ones. held: those that calibrate."""
    views_, axes = Views.fit(known, known, held), len(known.two)
    for _ in range(rounds):

        def gather(batches: Iterator[pa.RecordBatch], views_=views_) -> Iterator[pa.RecordBatch]:
            given = [Sums.none(axes), Sums.none(axes)]  # what the text view, and the metadata view, is given by the other one
            for batch in batches:
                a = np.array([np.frombuffer(x, np.float16) for x in batch.column(0).to_pylist()], np.float32).reshape(-1, axes)
                b = np.array(batch.column(1).to_pylist(), np.int64).reshape(-1, 5)
                for v, named in enumerate(views_.named(a, b)):
                    for label, at in enumerate(named):
                        given[1 - v].add(label, a[at], b[at])
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([g.flat() for g in given])], pa.list_(pa.float64()))], ["x"])

        got = _total(free.mapInArrow(gather, "x array<double>")).reshape(2, -1)
        if not got.size:
            break
        views_ = Views.fit(*(Sums.of(known.flat() + g, axes) for g in got), held)
    return views_


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    own = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    open_ = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", *[c for c in ("text", "lang", "source", "n_chars") if c in docs.columns])
    picked = own.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    seen = _columns(open_.join(F.broadcast(picked), "doc_id"), F.xxhash64("doc_id").alias("h"), "y")  # at most labelled
    got = sorted(_seen(seen, None).distinct().collect(), key=lambda r: (r["h"], r["a"], r["b"]))
    y = np.array([r["y"] for r in got], np.int64)
    cut = int(len(y) * (1 - CALIBRATE))
    if cut < 2 or len(set(y[:cut].tolist())) < 2 or len(set(y[cut:].tolist())) < 2:
        return Model(float(y.mean()) if len(y) else 0.5)
    shares = np.array([np.frombuffer(r["a"], np.float16) for r in got], np.float32)
    axes, cells = Axes.of(shares[:cut]), np.array([r["b"] for r in got], np.int64)
    text = axes.place(shares)
    known = Sums.none(text.shape[1])
    for label in (0, 1):
        own_rows = np.flatnonzero(y[:cut] == label)
        known.add(label, text[own_rows], cells[own_rows])
    # Texts become views before rows meet labels, so that no text is shuffled.
    every = _seen(_columns(open_, F.col("doc_id").cast("long").alias("h"), F.lit(-1).alias("y")), axes)
    free = every.join(own.select(F.col("doc_id").cast("long").alias("h")), "h", "left_anti")
    views_ = co_train(materialize(free.select("a", "b"), "quality-views"), known, (text[cut:], cells[cut:], y[cut:]))
    both = np.column_stack([c.raw(x[:, None]) for c, x in zip(views_.sure, (views_.text.raw(text[cut:]), views_.cells.raw(cells[cut:])), strict=True)])
    model = Model(float(y[:cut].mean()), axes)
    model.parts = (views_.text, views_.sure[0]), (views_.cells, views_.sure[1]), Logistic(l2=1e-3, steps=300).fit(both, y[cut:].astype(np.float32))
    return model


def _seen(rows: DataFrame, axes: Axes | None) -> DataFrame:
    """(h, y, a, b) of rows (h, y, text, lang, source, n_chars): shares, or places on axes, as 16-bit numbers, and cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                text, cells = views(part, 2)
                text = (text if axes is None else axes.place(text)).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x.tobytes() for x in text], pa.binary()), pa.array(cells.tolist(), pa.list_(pa.int32()))], ["h", "y", "a", "b"])

    return rows.mapInArrow(run, "h long, y int, a binary, b array<int>")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, text_score, metadata_score, score, predicted) of every document; 1 is good."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                s = model.score(*views(part, 2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(np.asarray(x, np.float64)) for x in s), pa.array((s[2] >= 0.5).astype(np.int32))], ["doc_id", "held_out", "text_score", "metadata_score", "score", "predicted"])

    return _columns(docs, F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, text_score double, metadata_score double, score double, predicted int")
