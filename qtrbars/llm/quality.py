"""Operator 4: quality classifier by positive-unlabelled learning.

Learned from trusted positives (documents labelled 1) and unlabelled web text
(documents taken without looking at their labels) with the non-negative
unbiased risk

    prior * E_p[loss(g, +1)] + max(0, E_u[loss(g, -1)] - prior * E_p[loss(g, -1)])

where the loss is logistic, so the sigmoid of g estimates the chance of label
1. Where the part in max() falls below zero on a batch, the step goes up that
part's gradient instead, which keeps a flexible model from fitting the
positives as negatives. The class prior is estimated as the share of
positives among the documents checked for labels (with one of each kind
added), or is given.

Features are counts of runs of four character classes (small and capital
letters, digits, each punctuation mark, white space, other) of the whole
text, hashed to ``BUCKETS``, as logarithms of their frequency, and likewise the
words that repeat the one before; a small two-layer network is trained in numpy on the driver. At most
``sample_docs`` positives and as many unlabelled documents are learned from,
the least by hash; all documents are scored in one pass without a shuffle.

Defined results: null and empty texts have no features and get the score the
network gives to that; without positives, or without learned rows, all scores
are the prior; null ids and null labels are never learned from; repeated rows
repeat their score; of several labels of a document, all count, of several texts the least is
learned from; an empty input
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import held_out
from .sampling import least_by_hash
from .sketch import packed, unpacked
from .text import Rolling, release, slices, splitmix, text_buffer, trimmed, word_bounds

BUCKETS = 1024
RUN = 4
HIDDEN = 16
SAMPLE_DOCS = 4000
THRESHOLD = 0.3
#: Rows whose features are held at once.
ROWS = 1000

_CLASS = np.zeros(256, np.uint64)  # 0: other; each ASCII character that isn't a letter or digit is its own class
_CLASS[33:127] = np.arange(33, 127)
_CLASS[[32, 9, 10, 11, 12, 13]] = [32, 32, 10, 32, 32, 32]
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 48, 65, 97
_CLASS[128:] = 128


@dataclass
class Model:
    prior: float
    layers: list[np.ndarray] | None  # weights, bias, weights, bias
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(features), self.prior)
        g = _answers(self.layers, (features - self.centre) / self.scale)[0]
        return 1 / (1 + np.exp(-np.clip(g.astype(np.float64), -30, 30)))


def features(column: pa.Array) -> np.ndarray:
    """(n, BUCKETS + 1) logarithms of the frequencies of class runs, and of repeated words, of whole texts."""
    data, off = text_buffer(column)
    n = len(off) - 1
    counts = np.zeros((n, BUCKETS), np.float32)
    if len(data) >= RUN:
        classes = _CLASS[data]
        code = np.zeros(len(data) - RUN + 1, np.uint64)
        for k in range(RUN):
            code = code * np.uint64(131) + classes[k:len(data) - RUN + 1 + k]
        bucket = (splitmix(code) % np.uint64(BUCKETS)).astype(np.int64)
        doc = np.repeat(np.arange(n), np.diff(off))
        whole = doc[:len(bucket)] == doc[RUN - 1:]
        counts = np.bincount((doc[:len(bucket)] * BUCKETS + bucket)[whole], minlength=n * BUCKETS)
        counts = counts.reshape(n, BUCKETS).astype(np.float32)
    starts, ends, rows = word_bounds(data, off)
    words = Rolling(data).of(starts, ends)
    again = np.flatnonzero((words[1:] == words[:-1]) & (rows[1:] == rows[:-1]))
    share = np.bincount(rows[again], minlength=n) / np.maximum(np.bincount(rows, minlength=n), 1)
    return np.log1p(1000 * np.column_stack([counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), share])
                    ).astype(np.float32)


def _answers(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ layers[0] + layers[1], 0)
    return (hidden @ layers[2] + layers[3])[:, 0], hidden


def _moments(samples: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and deviation + 0.1, of the rows of all samples, some rows at a time."""
    blocks = [(x, a) for x in samples for a in range(0, len(x), ROWS)]
    n = sum(len(x) for x in samples)
    mean = sum(x[a:a + ROWS].sum(axis=0, dtype=np.float64) for x, a in blocks) / n
    spread = sum(((x[a:a + ROWS] - mean) ** 2).sum(axis=0) for x, a in blocks) / n
    return mean.astype(np.float32), (np.sqrt(spread) + 0.1).astype(np.float32)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 12, seed: int = 11,
          rate: float = 0.002, decay: float = 1e-4, beta: float = 0.0) -> Model:
    """Minimise the non-negative risk by Adam, in batches with a share of both samples.

    The samples may be half-precision; only the rows of a batch are widened.
    """
    rng = np.random.default_rng(seed)
    centre, scale = _moments([positive, unlabelled])
    layers = [rng.normal(0, 0.05, (len(centre), HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 0.3, (HIDDEN, 1)), np.zeros(1)]
    layers = [x.astype(np.float32) for x in layers]
    moment, square, step = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers], 0
    size = 128
    batches = max(1, len(unlabelled) // size)
    for _ in range(epochs):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for b in range(batches):
            p = positive[p_order[np.arange(b * size, (b + 1) * size) % len(positive)]]
            u = unlabelled[u_order[b * size:(b + 1) * size]]
            x = (np.concatenate([p, u]).astype(np.float32) - centre) / scale
            g, hidden = _answers(layers, x)
            chance = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            gp, gu = g[:len(p)], g[len(p):]
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            slope = np.empty_like(g)
            if negative >= -beta:
                slope[:len(p)] = prior * ((chance[:len(p)] - 1) - chance[:len(p)]) / len(p)
                slope[len(p):] = chance[len(p):] / len(u)
            else:  # go up the gradient of the part that fell below zero
                slope[:len(p)] = prior * chance[:len(p)] / len(p)
                slope[len(p):] = -chance[len(p):] / len(u)
            back = (slope[:, None] @ layers[2].T) * (hidden > 0)
            grads = [x.T @ back + decay * layers[0], back.sum(axis=0), hidden.T @ slope[:, None], slope.sum(keepdims=True)]
            step += 1
            for w, d, m, s in zip(layers, grads, moment, square):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return Model(prior, layers, centre, scale)


def _featured(texts: DataFrame) -> DataFrame:
    """(kind, vec): the features of rows of (kind, text), compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = [packed(v.tobytes()) for part in _parts(batch[1]) for v in features(part).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(vec, pa.binary())], names=["kind", "vec"])

    return texts.mapInArrow(trimmed(run), "kind int, vec binary")


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most ROWS texts and a bounded number of bytes (or one longer text)."""
    for a in range(0, len(texts), ROWS):
        rows = texts.slice(a, ROWS)
        for first, last in slices(rows):
            yield rows.slice(first, last - first)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, class_prior: float | None = None) -> Model:
    """Learn from documents not held out: those labelled 1, and a sample without regard to labels."""
    learn = ~held_out(id_col) & F.col(id_col).isNotNull()
    marked = labels.where(learn & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"),
                                                                       F.col(label_col).alias("label"))
    if class_prior is None:
        ones, checked = marked.agg(F.sum((F.col("label") == 1).cast("int")), F.count("*")).first()
        class_prior = ((ones or 0) + 1) / (checked + 2)
    order = F.xxhash64(F.col("id").cast("string"))
    texts = docs.where(learn).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # the samples' ids first (bounded), then only their texts

    def least(ids: DataFrame) -> list:
        return [r["id"] for r in least_by_hash(ids, order, sample_docs, ["o", "id"],
                                               lambda near: near.distinct().withColumn("o", order))]

    picked = {1: least(marked.where("label = 1").select("id")), 0: least(texts.select("id"))}
    rows = [(i, kind) for kind, ids in picked.items() for i in ids]
    if not picked[1] or not picked[0]:
        return Model(class_prior, None)
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame(rows, f"id {kind}, kind int")
    # one text an id, whatever the number of its rows
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "kind").agg(F.min("text").alias("text"))
    found = _featured(sample.select("kind", "text")).collect()
    # rows arrive in any order: sort them (unlabelled ones first), so that the same tables give the same model
    found.sort(key=lambda r: (r["kind"], hashlib.sha1(r["vec"]).digest()), reverse=True)
    first = sum(r["kind"] == 0 for r in found)
    if not 0 < first < len(found):
        return Model(class_prior, None)
    rows = np.empty((len(found), BUCKETS + 1), np.float16)
    for k in range(len(found)):  # each vector is let go once it is in place
        rows[k] = np.frombuffer(unpacked(found.pop()["vec"]), np.float16)
    model = train(rows[first:], rows[:first], class_prior)
    del rows
    release()
    return model


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` as a column ``row`` of structs, with the score of each text.

    Only texts go to Python, once, and only the scores come back.
    """
    def scores(texts: pa.Array) -> pa.Array:
        found = [model.score(features(part)).astype(np.float64) for part in _parts(texts)]
        release()
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.struct("*").alias("row"), F.arrow_udf(scores, "double")(text).alias(score_col))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(row, score, predicted) of every document, by a model learned from those not held out."""
    scored = score(docs, fit(docs, labels, **options))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
