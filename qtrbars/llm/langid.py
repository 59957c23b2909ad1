"""Operator 2: language identification by a byte convolutional network.

Text is cut into windows of a fixed number of UTF-8 bytes (A-Z lowered, the
last window filled up with zeros). Filters of several widths run over the
bytes of a window, the strongest answer of each filter is kept, and a softmax
layer gives the languages. A document's probabilities are the mean over all
its windows, weighted by their bytes.

The network is trained in numpy on the driver from a sample of at most
``sample_docs`` labelled documents, the least by hash, of one window each; all
documents are then classified in full, in one pass without a shuffle.

Defined results: text that is null or holds no letter is ``und`` with score 0,
as is any text if nothing could be learned; a null id is never learned from
and not held out; repeated rows repeat their result; an empty input gives no
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import least_by_hash
from .text import lower_ascii, release, slices, text_buffer

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 4
SAMPLE_DOCS = 4000
#: Windows run through the network together.
BATCH = 64


def held_out(id_col: str) -> Column:
    """True for the fifth of documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Network:
    langs: list[str]
    filters: list[np.ndarray]  # by offset: (256, filters that reach there), the widest filters last
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def _cut(windows: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """Filter answers at every place of windows (n, WINDOW): (n, places, filters)."""
    places = windows.shape[1] - len(filters) + 1
    index = windows.astype(np.intp)
    total = filters[0].take(index[:, :places], axis=0)
    count = total.shape[2]
    for k, f in enumerate(filters[1:], 1):
        total[:, :, count - f.shape[1]:] += f.take(index[:, k:k + places], axis=0)
    return total


def forward(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities (n, languages) of windows (n, WINDOW) of bytes."""
    out = []
    for a in range(0, len(windows), BATCH):
        top = np.maximum(_cut(windows[a:a + BATCH], net.filters).max(axis=1) + net.bias, 0)
        out.append(_softmax(top @ net.out + net.out_bias))
    return np.concatenate(out) if out else np.zeros((0, len(net.langs)), np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], epochs: int = 10, seed: int = 7, rate: float = 0.01) -> Network:
    """Fit the network to windows of text, each of at most WINDOW bytes, by Adam."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels])
    count = FILTERS * len(WIDTHS)
    reach = [FILTERS * sum(w > k for w in WIDTHS) for k in range(max(WIDTHS))]
    params = [rng.normal(0, 0.1, (256, r)).astype(np.float32) for r in reach]
    params += [np.zeros(count, np.float32), rng.normal(0, 0.2, (count, len(langs))).astype(np.float32),
               np.zeros(len(langs), np.float32)]
    moment, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = (len(y) / np.bincount(y, minlength=len(langs))) ** 0.5
    weight = (weight / weight[y].mean()).astype(np.float32)
    data = [lower_ascii(np.frombuffer(t[:WINDOW], np.uint8)) for t in texts]
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), 64):
            pick = order[a:a + 64]
            windows = np.zeros((len(pick), WINDOW), np.uint8)
            for row, i in enumerate(pick):
                # a random part of the window, so that short texts are learned too
                t = data[i]
                n = int(len(t) * rng.random()) if rng.random() < 0.5 else len(t)
                n = max(n, min(len(t), 12))
                at = int(rng.integers(0, len(t) - n + 1))
                windows[row, :n] = t[at:at + n]
            filters, bias, out, out_bias = params[:-3], params[-3], params[-2], params[-1]
            answers = _cut(windows, filters)
            where = answers.argmax(axis=1)
            top = np.take_along_axis(answers, where[:, None], axis=1)[:, 0] + bias
            kept = np.maximum(top, 0)
            slope = _softmax(kept @ out + out_bias)
            slope[np.arange(len(pick)), y[pick]] -= 1
            slope *= weight[y[pick], None] / len(pick)
            back = (slope @ out.T) * (top > 0)
            grads = []
            for k, r in enumerate(reach):
                first = count - r
                at = np.take_along_axis(windows, (where[:, first:] + k), axis=1).astype(np.int64)
                cell = at * r + np.arange(r)
                grads.append(np.bincount(cell.ravel(), back[:, first:].ravel(), 256 * r).reshape(256, r))
            grads += [back.sum(axis=0), kept.T @ slope, slope.sum(axis=0)]
            step += 1
            for p, g, m, s in zip(params, grads, moment, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return Network(langs, params[:-3], params[-3], params[-2], params[-1])


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Train on one window of each of the ``sample_docs`` documents least by hash; None if there are none."""
    text = F.col(text_col).cast("string")
    order = F.xxhash64(F.col(id_col).cast("string"))

    def windows(near: DataFrame) -> DataFrame:
        return (near.where(text.rlike(r"\p{L}"))
                .select(order.alias("o"), F.col(lang_col).cast("string").alias("lang"), text.alias("t"))
                .select("o", "lang", F.substring("t", F.pmod("o", F.greatest(F.length("t") - WINDOW, F.lit(0)) + 1)
                                                 .cast("int") + 1, F.lit(WINDOW)).alias("t")))

    rows = least_by_hash(labelled.where(F.col(lang_col).isNotNull()), order, sample_docs, ["o", "lang", "t"], windows)
    if not rows:
        return None
    net = train([r["t"].encode() for r in rows], [r["lang"] for r in rows])
    release()
    return net


def document_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """Mean probabilities over all windows of each text: (n, languages)."""
    data, off = text_buffer(column)
    data = lower_ascii(data)
    size = np.diff(off)
    pieces = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = off[doc] + nth * WINDOW
    length = np.minimum(WINDOW, off[doc + 1] - start)
    total = np.zeros((len(size), len(net.langs)))
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    for a in range(0, len(doc), BATCH):
        at = slice(a, a + BATCH)
        windows = padded[start[at, None] + np.arange(WINDOW)]
        windows[np.arange(WINDOW) >= length[at, None]] = 0
        np.add.at(total, doc[at], forward(net, windows) * length[at, None])
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def classify(df: DataFrame, net: Network | None, text_col: str = "text", lang_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """``df`` as a column ``row`` of structs, with the language and score of each text.

    Only texts go to Python, once, and only the answers come back.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if net is None:
        return df.select(F.struct("*").alias("row"), F.lit("und").alias(lang_col), F.lit(0.0).alias(score_col))
    names = np.array([*net.langs, "und"], dtype=object)

    def answers(texts: pa.Array, spoken: pa.Array) -> pa.Array:
        langs, scores = [], []
        for a, b in slices(texts):
            found = document_probabilities(net, texts.slice(a, b - a))
            letters = spoken.slice(a, b - a).to_numpy(zero_copy_only=False).astype(bool)
            langs.append(names[np.where(letters, found.argmax(axis=1), len(net.langs))])
            scores.append(np.where(letters, found.max(axis=1), 0.0))
        release()
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(langs) if langs else [], pa.string()),
             pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["lang", "score"])

    found = F.arrow_udf(answers, "lang string, score double")(text, text.rlike(r"\p{L}"))
    return df.select(F.struct("*").alias("row"), found.alias("found")).select(
        "row", F.col("found.lang").alias(lang_col), F.col("found.score").alias(score_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(row, held_out, lang_pred, score): learn from the documents not held out, classify all."""
    net = fit(docs.where(~held_out(id_col) & F.col(id_col).isNotNull()), id_col, text_col, lang_col, sample_docs)
    return classify(docs, net, text_col)
