"""Operator 9: substring dedup of words with a count-min prefilter.

A window is 13 consecutive words (runs of characters that aren't white space)
of one document. A word goes if a window that covers it also starts, word for
word, in a document with a smaller id. A count-min sketch, merged from
sketches of the partitions, overestimates how many documents hold each
window; a second pass groups exactly only the windows estimated repeated, and
loses none. The sketch counts each window by its anchor, the least hash of
the nine 5-word grams inside: at least as frequent as the window, and a
fifth as many to count. Windows are told apart by 128 bits of hashes.

Windows are judged on the input, not on what is left. Defined results: null
and empty texts have no words; a null id is kept whole; rows with one id, be
their texts the same or not, are judged each on its own and take nothing from each
other; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .repeats import HOT, Windows, covered, posed, repeated_spans
from .text import sliding_min, splitmix, text_buffer, trimmed, window_hash, word_bounds, word_hashes

WINDOW, GRAM = 13, 5


def windows(texts: pa.Array) -> Windows:
    data, off = text_buffer(texts)
    starts, ends, rows = word_bounds(data, off)
    first = np.searchsorted(rows, np.arange(len(off)))
    one, two = (word_hashes(data, starts, ends, seed) for seed in (0, 1))
    at = np.flatnonzero(rows[:max(0, len(rows) - WINDOW + 1)] == rows[WINDOW - 1:])
    anchor = sliding_min(window_hash(one, GRAM), WINDOW - GRAM + 1)[at]
    key, other = window_hash(one, WINDOW)[at], window_hash(two, WINDOW, 1)[at]

    def identity(head: np.ndarray, size: np.ndarray) -> np.ndarray:
        total = np.cumsum(size)
        nth = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size)
        mixed = splitmix(other[np.repeat(head, size) + nth] + nth.astype(np.uint64))
        return np.add.reduceat(mixed, total - size) if len(head) else mixed

    def body(head: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.cumsum(size)
        nth = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size)
        return other[np.repeat(head, size) + nth].view(np.uint8), 8 * np.append(0, total)

    return Windows(anchor, rows[at], at - first[rows[at]], lambda w: key[w], identity, body)


def same_windows(route: np.ndarray, doc: np.ndarray, n: np.ndarray, bodies: np.ndarray, off: np.ndarray,
                 size: np.ndarray) -> np.ndarray:
    """Group equal windows exactly; true where a smaller document has the window."""
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    window = bodies.view("<u8")[off[owner] // 8 + nth]
    anchor, holder = route[owner], doc[owner]
    order = np.lexsort((holder, window, anchor))
    a, w, d = anchor[order], window[order], holder[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
    gone = np.zeros(len(order), bool)
    gone[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return gone


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell_bits: int = sketch.CELL_BITS,
            hot: int = HOT) -> DataFrame:
    """(doc, mark, spans): packed runs of repeated windows of the texts that have any."""
    return repeated_spans(posed(docs, id_col, text_col).where("doc is not null"), windows, same_windows, cell_bits, hot)


def _joined(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    found = repeats(docs, id_col, text_col, **options)
    rows = posed(docs, id_col, text_col, F.struct("*").alias("row"))
    return rows.join(found.hint("shuffle_hash"), ["doc", "mark"], "left")


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch[1], batch[2].to_pylist()):
                words = (text.as_py() or "").encode().split()
                gone = covered(spans, WINDOW, len(words))
                kept = b" ".join([w for w, g in zip(words, gone) if not g] if spans else words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch[0], *(pa.array([x[k] for x in out], t) for k, t in
                             enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=[id_col, "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _joined(docs.select(id_col, text_col), id_col, text_col, **options).select(
        F.col(f"row.{id_col}").alias(id_col), "text", "spans").mapInArrow(
        trimmed(run), f"{id_col} {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their repeated words, all columns as they were.

    Words that stay keep the white space around them; that before a removed
    word goes with it. A text that loses all its words becomes empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch[1], batch[2].to_pylist()):
                text = text.as_py()
                texts.append(without(text, spans) if text and spans else text)
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(texts, pa.string())], names=["row", "text"])

    joined = _joined(docs, id_col, text_col, **options).select("row", "text", "spans")
    kept = joined.mapInArrow(trimmed(run), f"row {joined.schema['row'].dataType.simpleString()}, text string")
    return kept.select(*[F.col("text").cast(f.dataType).alias(f.name) if f.name == text_col
                         else F.col("row").getField(f.name).alias(f.name) for f in docs.schema])


def without(text: str, spans: bytes) -> str:
    """The text without the words that spans cover."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    gone = covered(spans, WINDOW, len(starts))
    if not gone.any():
        return text
    if gone.all():
        return ""
    kept = np.flatnonzero(~gone)
    # a word that stays brings the space before it, unless none stays before it
    begin = np.append(0, ends[:-1])[kept]
    begin[0] = starts[kept[0]] if kept[0] else 0
    tail = raw[ends[-1]:] if not gone[-1] else b""
    return (b"".join([raw[a:b] for a, b in zip(begin, ends[kept])]) + tail).decode()
