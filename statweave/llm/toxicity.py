"""Toxicity by a classifier chain of linear models.

Categories are predicted in order; each model sees the words of a text, their
beginnings and the probabilities of the categories before it.  The models are logistic with an
L1 penalty, so only words that carry evidence keep a weight.  A later model is
trained on out-of-fold probabilities of the earlier ones (``FOLDS`` folds by a
hash of the id), as it will see them on new texts; the thresholds are those
with the best F1 on out-of-fold predictions.

The models are fitted on a bounded sample of labelled rows: about
``TRAIN_DOCS`` whole documents drawn by hash (a documented parameter), and the
``VOCABULARY`` most frequent words of the sample.  Scoring reads every text
whole in Arrow batches; nothing is shuffled.

Defined cases: null texts have no words; rows with a null label are not
learned from; without labels of both kinds a category's probability is its
rate and nothing is flagged; repeated rows are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .licenses import words

# Besides itself a longer word counts as its beginnings of so many bytes, so
# that inflected forms of one stem share a feature.
STEM_BYTES = (4, 5)
TRAIN_DOCS = 6000
VOCABULARY = 40_000
MIN_DOCS = 4
FOLDS = 3
L1 = 0.003
STEPS = 200


def features(text: bytes) -> Counter:
    """How often every word and every stem (``stem*``) occurs."""
    counts = Counter(words(text))
    out = Counter(counts)
    for w, n in counts.items():
        for k in STEM_BYTES:
            if len(w) > k:
                out[w[:k] + b"*"] += n
    return out


@dataclass
class Link:
    """One model of the chain: word weights, weights of the earlier
    categories, bias and threshold."""
    name: str
    weights: dict[bytes, float]
    chain: np.ndarray
    bias: float
    threshold: float

    def probability(self, counts: dict[bytes, int], before: list[float]) -> float:
        z = self.bias + float(np.dot(self.chain, before))
        for w, n in counts.items():
            if w in self.weights:
                z += self.weights[w] * np.log1p(n)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


class Rows:
    """Sparse rows: word numbers and values of each document, in one array."""

    def __init__(self, idx: np.ndarray, val: np.ndarray, row: np.ndarray, n: int, width: int):
        self.idx, self.val, self.row, self.n, self.width = idx, val, row, n, width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.idx], self.n)

    def grad(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.idx, self.val * g[self.row], self.width)

    def take(self, keep: np.ndarray) -> Rows:
        number = np.cumsum(keep) - 1
        at = keep[self.row]
        return Rows(self.idx[at], self.val[at], number[self.row[at]], int(keep.sum()), self.width)


def fit_logistic(x: Rows, dense: np.ndarray, y: np.ndarray, l1: float = L1,
                 steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """L1 logistic regression by accelerated proximal gradient; both classes
    weigh the same; the dense columns and the bias are not penalised."""
    pos = y.mean()
    if not 0 < pos < 1:
        return np.zeros(x.width), np.zeros(dense.shape[1]), float(np.log((pos + 1e-6) / (1 - pos + 1e-6)))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / (1 - pos)) / len(y)
    d = np.column_stack([dense, np.ones(len(y))])
    # Step length from the largest eigenvalue of the weighted Gram matrix.
    v, u, size = np.ones(x.width), np.ones(d.shape[1]), 1.0
    for _ in range(12):
        z = weight * (x.dot(v) + d @ u)
        v, u = x.grad(z), d.T @ z
        size = np.sqrt(v @ v + u @ u) or 1.0
        v, u = v / size, u / size
    step = 4 / (1.2 * size)
    w, b = np.zeros(x.width), np.zeros(d.shape[1])
    w_ahead, b_ahead, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w_ahead) + d @ b_ahead, -50, 50)))
        g = weight * (p - y)
        w_new = w_ahead - step * x.grad(g)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * l1, 0)
        b_new = b_ahead - step * (d.T @ g)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_ahead = w_new + (t - 1) / t_new * (w_new - w)
        b_ahead = b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b[:-1], float(b[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The midpoint threshold with the best F1; 1.01 without positives."""
    if not y.any():
        return 1.01
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def train(sample: DataFrame, categories: list[str]) -> list[Link]:
    """(doc_id, text, category columns 0/1) -> the chain."""
    ws = cut(_word_counts(sample, categories))
    vocabulary = [bytes(r["word"]) for r in ws.select(F.explode("words").alias("word"))
                  .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_DOCS)
                  .orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()]
    t = ws.orderBy("doc_id").toArrow()  # bounded by the sample
    names = t.column("words").combine_chunks()
    row = np.repeat(np.arange(t.num_rows), pc.list_value_length(names).to_numpy(zero_copy_only=False))
    number = pc.index_in(names.flatten(), pa.array(vocabulary, pa.binary()))
    known = pc.is_valid(number).to_numpy(zero_copy_only=False)
    counts = t.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = Rows(number.drop_null().to_numpy(zero_copy_only=False).astype(np.int64),
             np.log1p(counts[known].astype(float)), row[known], t.num_rows, len(vocabulary))
    fold = np.array(t.column("fold").to_pylist(), np.int64)
    before = np.zeros((t.num_rows, 0))
    links = []
    for name in categories:
        y = np.array(t.column(name).to_pylist(), float)
        if not t.num_rows:
            links.append(Link(name, {}, np.zeros(len(links)), -20.0, 1.01))
            continue
        oof = np.zeros(t.num_rows)
        for f in range(FOLDS):
            out = fold == f
            if not out.any() or out.all():
                oof[out] = y.mean()
                continue
            w, c, b = fit_logistic(x.take(~out), before[~out], y[~out])
            z = x.dot(w) + before @ c + b
            oof[out] = 1 / (1 + np.exp(-np.clip(z[out], -50, 50)))
        w, c, b = fit_logistic(x, before, y)
        links.append(Link(name, {vocabulary[i]: float(w[i]) for i in np.flatnonzero(w)}, c, b,
                          best_threshold(oof, y)))
        before = np.column_stack([before, oof])
    return links


def _word_counts(sample: DataFrame, categories: list[str]) -> DataFrame:
    fields = "".join(f", {c} int" for c in categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted = [features(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([list(c) for c in counted], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in counted], pa.list_(pa.int32())),
                 *(b.column(k) for k in range(2, b.num_columns))],
                names=["doc_id", "words", "counts", "fold", *categories])

    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), fold,
                         *[F.col(c).cast("int") for c in categories]).mapInArrow(
        run, f"doc_id long, words array<binary>, counts array<int>, fold int{fields}")


def score(docs: DataFrame, chain: list[Link]) -> DataFrame:
    """doc_id and, per category, probability ``p_<name>`` and flag ``<name>``."""
    schema = "doc_id long" + "".join(f", p_{x.name} double, {x.name} boolean" for x in chain)
    known = frozenset(w for x in chain for w in x.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                columns: list[list] = [[] for _ in range(2 * len(chain))]
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    counts = {w: n for w, n in features(t).items() if w in known}
                    before: list[float] = []
                    for k, link in enumerate(chain):
                        p = link.probability(counts, before)
                        columns[2 * k].append(p)
                        columns[2 * k + 1].append(p >= link.threshold)
                        before.append(p)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.float64() if k % 2 == 0 else pa.bool_())
                                       for k, c in enumerate(columns))],
                    names=["doc_id"] + [n for x in chain for n in (f"p_{x.name}", x.name)])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
                       ).mapInArrow(run, schema)


def training_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
                    max_docs: int = TRAIN_DOCS) -> DataFrame:
    """About ``max_docs`` labelled documents by a hash of the id.  A document
    with several label rows is of a category if any row says so; rows with a
    null label do not count."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          *[c.cast("int").alias(n) for n, c in categories.items()]).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in categories])
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * min(
        1.0, max_docs / max(n, 1)))
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """Train the chain on the labelled sample and score every document."""
    chain = train(training_sample(docs, labels, categories), list(categories))
    return score(docs, chain)
