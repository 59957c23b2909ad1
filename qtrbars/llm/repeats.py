"""Windows that documents share, found by content-chosen anchors.

Each window's anchor is the least hash of the short grams inside it, so equal
windows have equal anchors, and a run of neighbouring windows mostly shares
one: such a run is a context. The steps, for windows of any unit:

1. A count-min sketch over all documents counts anchors. A window whose anchor
   is in one document only can't repeat and goes no further; the estimate
   never misses one that does.
2. Contexts of the anchors left are settled inside their slice of text first:
   of equal contexts only that of the smallest document goes on, the others
   repeat it. So a passage, however frequent, sends one row for each slice.
   The rest is dealt by anchor, packed into one blob for each slice and part.
   Anchors estimated in very many documents are dealt window by window, by
   the window's own hash, as the text around a frequent line differs.
3. In each part, a resolver compares the windows that share an anchor exactly,
   and says which also start in a smaller document.
4. What is to go is gathered by document and joined to the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sketch
from .text import slices, splitmix, trimmed

#: Longest context, in windows; longer runs are cut.
RUN = 64
#: Bytes of text in which equal contexts are settled first.
SLICE_BYTES = 1 << 21
#: Documents (estimated) from which an anchor's windows are dealt one by one.
HOT = 4096


@dataclass
class Windows:
    """The windows of a slice of documents, in order."""
    anchor: np.ndarray  # uint64
    row: np.ndarray     # document's place in the slice
    start: np.ndarray   # first unit, counted in the document
    key: Callable[[np.ndarray], np.ndarray]  # window -> hash of it
    identity: Callable[[np.ndarray, np.ndarray], np.ndarray]  # (window, number) -> another hash, of a run of windows
    body: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]  # -> (bytes, offsets) of runs

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """(first window, number of windows) of each run with one anchor."""
        n = len(self.anchor)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(n, bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.row[1:] != self.row[:-1])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, n))
        if size.max() > RUN:
            pieces = -(-size // RUN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(RUN, np.repeat(size, pieces) - nth * RUN)
            head = np.repeat(head, pieces) + nth * RUN
        return head, size


def posed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc, mark, text, ...): the mark, a hash of the text, tells rows with one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"), *more)


def _sliced(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(documents, texts) of slices of a batch of (doc, mark, text); a document is (doc, mark)."""
    ids = np.stack([batch[0].to_numpy(), batch[1].to_numpy()], axis=1)
    for a, b in slices(batch[2], limit):
        yield ids[a:b], batch[2].slice(a, b - a)


def _joined(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in order, those that follow on joined."""
    order = np.lexsort((start, doc[:, 1], doc[:, 0]))
    doc, start, n = doc[order], start[order], n[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]).any(axis=1) | (start[1:] != start[:-1] + n[:-1])
    head = np.flatnonzero(new)
    return doc[head], start[head], np.add.reduceat(n, head) if len(head) else n


def _spans(doc: np.ndarray, start: np.ndarray, n: np.ndarray, tasks: int) -> Iterator[pa.RecordBatch]:
    """Rows (-1 - share, blob) of runs of windows to go, one for each share of the documents."""
    if not len(doc):
        return
    doc, start, n = _joined(doc, start, n)
    share = (splitmix(doc[:, 0].astype(np.uint64) + doc[:, 1].astype(np.uint64)) % np.uint64(tasks)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    edge = np.searchsorted(share[order], np.arange(tasks + 1))
    numbers, blobs = [], []
    for k in range(tasks):
        at = order[edge[k]:edge[k + 1]]
        if len(at):
            numbers.append(-1 - k)
            blobs.append(b"".join([doc[at].astype("<i8").tobytes(), start[at].astype("<i4").tobytes(),
                                   n[at].astype("<i4").tobytes()]))
    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())],
                                     names=["part", "data"])


def _by_document(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows (document, packed (start, length) pairs) of blobs of runs."""
    if not blobs:
        return
    fields: tuple[list[np.ndarray], ...] = ([], [], [])
    for blob in blobs:
        count = len(blob) // 24
        fields[0].append(np.frombuffer(blob, "<i8", 2 * count).reshape(count, 2))
        for k, at in ((1, 16), (2, 20)):
            fields[k].append(np.frombuffer(blob, "<i4", count, at * count))
    doc, start, n = _joined(*(np.concatenate(f).astype(np.int64) for f in fields))
    pairs = np.stack([start, n], axis=1).astype("<i4")
    edge = np.append(np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]).any(axis=1)])), len(doc))
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[edge[:-1], 0]), pa.array(doc[edge[:-1], 1]),
         pa.array([pairs[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
        names=["doc", "mark", "spans"])


def _pack(part: np.ndarray, route: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray, body: np.ndarray,
          off: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (part, blob) of contexts in order of their parts, one for each part."""
    edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    size = np.diff(off)
    numbers, blobs = part[edge[:-1]], []
    for a, b in zip(edge[:-1], edge[1:]):
        blobs.append(sketch.packed(b"".join([np.int64(b - a).tobytes(), route[a:b].tobytes(), doc[a:b].astype("<i8").tobytes(),
                               start[a:b].astype("<i4").tobytes(), n[a:b].astype("<i4").tobytes(),
                               size[a:b].astype("<i4").tobytes(), body[off[a]:off[b]].tobytes()])))
    if blobs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "data"])


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """(route, doc, start, n, size, bodies) of blobs put together."""
    fields: list[list[np.ndarray]] = [[] for _ in range(6)]
    for blob in map(sketch.unpacked, blobs):
        count = int(np.frombuffer(blob, "<i8", 1)[0])
        at = 8
        for k, (kind, wide) in enumerate((("<u8", 1), ("<i8", 2), ("<i4", 1), ("<i4", 1), ("<i4", 1))):
            fields[k].append(np.frombuffer(blob, kind, wide * count, at))
            at += wide * count * np.dtype(kind).itemsize
        fields[1][-1] = fields[1][-1].reshape(count, 2)
        fields[5].append(np.frombuffer(blob, np.uint8, -1, at))
    return tuple(np.concatenate(f) for f in fields)


def _settle(w: Windows, ids: np.ndarray, head: np.ndarray, size: np.ndarray, route: np.ndarray,
            parts: int, tasks: int) -> Iterator[pa.RecordBatch]:
    """Equal contexts of a slice: all but the smallest document's repeat it; that one is dealt to its part."""
    if not len(head):
        return
    row, same = w.row[head], w.identity(head, size)
    # sorted by one number: should unequal contexts have it and mix, equal ones apart from each other all go on
    order = np.argsort(splitmix(route) ^ same)
    r, s, d = route[order], same[order], ids[row[order], 0]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    repeat = np.empty(len(order), bool)
    repeat[order] = d > np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
    gone = np.flatnonzero(repeat)
    yield from _spans(ids[row[gone]], w.start[head[gone]], size[gone], tasks)
    kept = np.flatnonzero(~repeat)
    part = (splitmix(route[kept]) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    kept = kept[order]
    body, off = w.body(head[kept], size[kept])
    yield from _pack(part[order], route[kept], ids[row[kept]], w.start[head[kept]], size[kept], body, off)


def repeated_spans(docs: DataFrame, windows: Callable[[pa.Array], Windows],
                   resolver: Callable[..., np.ndarray], cell_bits: int = sketch.CELL_BITS,
                   hot: int = HOT, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc, mark, spans): packed (first window, number of windows) pairs of 32-bit
    numbers, of windows that also start in a document with a smaller id.

    ``docs`` are ``posed`` rows with a doc that isn't null. ``resolver`` gets
    (route, doc, n, size, bodies) of contexts sorted by route and returns, for
    each window of each context in turn, whether a smaller document has it.
    """
    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, texts in _sliced(batch, slice_bytes):
            w = windows(texts)
            yield w.anchor[w.contexts()[0]]

    repeated, many = sketch.over(sketch.partition_sketches(docs, anchors, cell_bits), [2, hot], cell_bits)
    marks = sketch.shared(docs, (repeated, many))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * tasks  # several a task, to even them out

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, frequent = marks.value
        for batch in batches:
            for ids, texts in _sliced(batch, slice_bytes):
                w = windows(texts)
                head, size = w.contexts()
                left = again.holds(w.anchor[head])
                head, size = head[left], size[left]
                often = frequent.holds(w.anchor[head])
                yield from _settle(w, ids, head[~often], size[~often], w.anchor[head[~often]], parts, tasks)
                # very frequent anchors: window by window, dealt by the window's hash
                total = size[often]
                each = np.repeat(head[often] - (np.cumsum(total) - total), total) + np.arange(total.sum())
                one = np.ones(len(each), np.int64)
                yield from _settle(w, ids, each, one, w.key(each), parts, tasks)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            settled = pc.less(batch["part"], 0)
            if pc.any(settled).as_py():
                yield batch.filter(settled)
            for p, blob in zip(batch["part"].to_pylist(), batch["data"]):
                if p >= 0:
                    blobs.setdefault(p, []).append(blob.as_py())
        for p in sorted(blobs):  # parts share no anchor: one at a time
            yield from resolved(blobs.pop(p))

    def resolved(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        route, doc, start, n, size, bodies = _unpack(blobs)
        order = np.argsort(route, kind="stable")
        off = np.cumsum(size) - size
        route, doc, start, n, size, off = (x[order] for x in (route, doc, start, n, size, off))
        again = np.concatenate([[False], route[1:] == route[:-1]])
        shared = again | np.append(again[1:], False)  # an anchor met once is no repeat
        route, doc, start, n, size, off = (x[shared] for x in (route, doc, start, n, size, off))
        if not len(route):
            return
        gone = np.flatnonzero(resolver(route, doc[:, 0], n, bodies, off, size))
        begin = np.cumsum(n) - n
        at = np.searchsorted(begin, gone, side="right") - 1
        yield from _spans(doc[at], start[at] + gone - begin[at], np.ones(len(at), np.int64), tasks)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_document([b.as_py() for batch in batches for b in batch["data"]])

    return (docs.mapInArrow(trimmed(collect), "part int, data binary")
            .repartition(tasks, "part").mapInArrow(trimmed(resolve), "part int, data binary")
            .repartition(tasks, "part").mapInArrow(trimmed(gather), "doc bigint, mark bigint, spans binary"))


def covered(spans: bytes | None, width: int, n: int) -> np.ndarray:
    """Mask of n units covered by windows of ``width`` units."""
    change = np.zeros(n + 1, np.int32)
    if spans:
        pairs = np.frombuffer(spans, "<i4").reshape(-1, 2)
        np.add.at(change, pairs[:, 0], 1)
        np.add.at(change, pairs[:, 0] + pairs[:, 1] + width - 1, -1)
    return np.cumsum(change[:-1]) > 0
