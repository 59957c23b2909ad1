"""Operator 5: document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs: its lines, cut further after a
sentence's end and its space. Each paragraph is hashed to a wide vector, and a fingerprint is the sum of the
vectors: 16 lanes modulo 2**64 that every paragraph adds to, and up to 24
levels of 64 narrow lanes, also modulo 2**64, of which a paragraph adds to one lane of one
level, both chosen by its hash: level l has a paragraph with chance
2**-(l + 1), the last one the rest. Levels of zeros at the end are left off,
so a fingerprint grows with the logarithm of the text. Sums don't depend on
order; a paragraph is inserted or deleted by adding or subtracting its vector.

Equal texts have equal fingerprints; the wide lanes tell others apart, the
narrow ones estimate how much two texts share, their multiset Jaccard. A
narrow lane counts its paragraphs in its lower 40 bits (10**12 of them) and sums
their hashes in the upper 24, so it shows whether both texts have the same paragraphs in
it, or how many more one has. Levels l and above together are a sample of
2**-l of the paragraphs; the largest sample is read that leaves a third of the
lanes alike. Alike lanes share all they count; of the others, the expected
share is taken (paragraphs fall into lanes by chance, at the rates found).
Texts that differ in up to some 70 paragraphs are read whole, longer ones
by sample.

Defined results: null is an empty text, of fingerprint zero; two fingerprints
of zero are alike (1.0), zero and another aren't (0.0); repeated ids follow
each other by a hash of their text, greatest first; null ids come after all
others; an empty input gives no rows. Ids are integers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import slices, trimmed

WIDE, NARROW, LEVELS = 16, 64, 24
#: Bytes of rows that go to Python at once.
BATCH_BYTES = 8 << 20
#: Bits of a narrow lane that count paragraphs.
COUNT = 40


_END = re.compile(r"\n|(?<=[.!?]) ")


def paragraphs(text: str) -> list[str]:
    return [p for p in _END.split(text) if p]


def _vectors(parts: list[str], known: dict[str, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the wide lanes, sum of the narrow lanes) of paragraphs; known: digests to look up and add to."""
    wide, narrow = np.zeros(WIDE, np.uint64), np.zeros(LEVELS * NARROW, np.uint64)
    if parts:
        known = {} if known is None else known
        digests = b"".join([known.get(p) or known.setdefault(p, _digest(p)) for p in parts])
        rows = np.frombuffer(digests, "<u8").reshape(len(parts), WIDE + 8)
        wide = rows[:, :WIDE].sum(axis=0, dtype=np.uint64)
        lowest = rows[:, WIDE + 2] & (~rows[:, WIDE + 2] + np.uint64(1))
        level = np.minimum(np.bitwise_count(lowest - np.uint64(1)), LEVELS - 1).astype(np.int64)
        np.add.at(narrow, level * NARROW + (rows[:, WIDE] % NARROW).astype(np.int64),
                  (rows[:, WIDE + 1] << np.uint64(COUNT)) + np.uint64(1))
    return wide, narrow


def _digest(paragraph: str) -> bytes:
    """Three 64-byte digests, the first of the paragraph, the others of the first."""
    one = hashlib.blake2b(paragraph.encode()).digest()
    return one + hashlib.blake2b(one, person=b"lanes").digest() + hashlib.blake2b(one, person=b"place").digest()


def _joined(wide: np.ndarray, narrow: np.ndarray) -> bytes:
    used = np.flatnonzero(narrow)
    levels = used[-1] // NARROW + 1 if len(used) else 0
    return wide.astype("<u8").tobytes() + narrow[:levels * NARROW].astype("<u8").tobytes()


def fingerprint(text: str | None, known: dict[str, bytes] | None = None) -> bytes:
    return _joined(*_vectors(paragraphs(text or ""), known))


def _split(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    narrow = np.zeros(LEVELS * NARROW, "<u8")
    held = np.frombuffer(value, "<u8", offset=WIDE * 8)
    narrow[:len(held)] = held
    return np.frombuffer(value, "<u8", WIDE), narrow


def add(one: bytes, other: bytes, sign: int = 1) -> bytes:
    """Fingerprint of the union of two multisets of paragraphs, or of what is left with sign -1."""
    (a, b), (c, d) = _split(one), _split(other)
    return _joined(a + c, b + d) if sign > 0 else _joined(a - c, b - d)


def insert(value: bytes, paragraph: str) -> bytes:
    return add(value, fingerprint(paragraph))


def delete(value: bytes, paragraph: str) -> bytes:
    return add(value, fingerprint(paragraph), -1)


def likeness(one: bytes, other: bytes) -> float:
    """1.0 for equal fingerprints, else the multiset Jaccard estimated from the largest sample of paragraphs
    that leaves a third of the narrow lanes alike."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(v, "<u8", offset=WIDE * 8).reshape(-1, NARROW) for v in (one, other))
    for level in range(max(len(a), len(b))):
        x, y = a[level:].sum(axis=0, dtype=np.uint64), b[level:].sum(axis=0, dtype=np.uint64)
        p, q = (x & _COUNTS).astype(np.int64), (y & _COUNTS).astype(np.int64)
        alike = x == y
        other_count = np.flatnonzero((p != q) & (p > 0) & (q > 0))
        if len(other_count):
            # one paragraph p and q times: the sums of its hash are as the counts, cut by what divides both
            u, v = p[other_count].astype(np.uint64), q[other_count].astype(np.uint64)
            g = np.gcd(u, v)
            alike[other_count] = (((x[other_count] >> np.uint64(COUNT)) * (v // g) - (y[other_count] >> np.uint64(COUNT)) * (u // g))
                                  << np.uint64(COUNT)) == 0
        if 3 * int(alike.sum()) >= NARROW:
            return _jaccard(p, q, alike)
    return 0.0


_COUNTS = np.uint64((1 << COUNT) - 1)
#: Pairs of differing paragraphs in a lane that are thought of.
PAIRS = np.arange(1, 33)[:, None]


def _jaccard(p: np.ndarray, q: np.ndarray, alike: np.ndarray) -> float:
    """Estimated multiset Jaccard of two texts that differ, from the counts of their lanes."""
    n, m, least = int(p.sum()), int(q.sum()), np.minimum(p, q)
    sure = float(least[alike].sum())
    shared = min(sure * NARROW / int(alike.sum()), float(least.sum()))
    mixed = ~alike & (least > 0)
    if mixed.any():
        k, more, even = least[mixed], np.abs(p - q)[mixed], (p == q)[mixed]
        parts = np.maximum(k - PAIRS + 1, 0) / (PAIRS * (PAIRS + more))
        for _ in range(2):
            # chance that j of a lane's paragraphs in either text face others, against none: Poisson counts of
            # shared and other paragraphs; lanes of even counts that aren't alike have one at least
            rate = max(n - shared, 0.5) * max(m - shared, 0.5) / max(shared, 0.02) / NARROW
            with np.errstate(divide="ignore"):
                chances = np.cumsum(np.log(parts * rate), axis=0)
            top = np.maximum(chances.max(axis=0), 0)
            chances = np.exp(chances - top)
            whole = chances.sum(axis=0) + np.where(even, 0, np.exp(-top))
            shared = sure + float((k - (chances * PAIRS).sum(axis=0) / whole).clip(0).sum())
    shared = min(shared, float(max(n + m - 1, 0) // 2))
    return shared / (n + m - shared) if n + m else 0.0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): hex of every whole text. No shuffle."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch[1]):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part[0], pa.array([fingerprint(t.as_py()).hex() for t in part[1]], pa.string())],
                    names=[id_col, "fingerprint"])

    return df.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"{id_col} {kind}, fingerprint string")


def sum_fingerprints(df: DataFrame, group: str | Column, fingerprint_col: str = "fingerprint") -> DataFrame:
    """(group, fingerprint) of the union of each group's documents.

    Words of 32 bits are summed by Spark, so a hot group is pre-aggregated in
    every task. Sums are exact to 2**31 documents a group.
    """
    value = F.col(fingerprint_col)
    words = F.transform(F.sequence(F.lit(0), (F.length(value) / 8).cast("int") - 1), lambda k: F.conv(
        F.concat(*[F.substring(value, k * 8 + F.lit(7 - 2 * i), F.lit(2)) for i in range(4)]), 16, 10).cast("bigint"))
    named = df.groupBy(group).agg(F.lit(None)).columns[0]
    summed = (df.select(F.col(group).alias("g") if isinstance(group, str) else group.alias("g"),
                        F.posexplode_outer(words).alias("k", "word"))
              .groupBy("g", "k").agg(F.sum("word").alias("word")))
    sums = summed.groupBy("g").agg(F.array_sort(F.collect_list(F.when(
        F.col("k").isNotNull(), F.struct("k", "word")))).alias("sums"))

    def little(c: Column) -> Column:
        x = F.lpad(F.hex(F.pmod(c, F.lit(1 << 32))), 8, "0")
        return F.lower(F.concat(*[F.substring(x, 7 - 2 * i, 2) for i in range(4)]))

    # the upper half of a lane takes what its lower half carries
    out = F.concat_ws("", F.transform("sums", lambda x: little(x["word"] + F.when(
        x["k"] % 2 == 1,
        F.shiftright(F.element_at(F.col("sums"), F.greatest(x["k"], F.lit(1)))["word"], 32)).otherwise(F.lit(0)))))
    # levels of zeros at the end are left off
    levels = F.regexp_replace(F.substring(out, WIDE * 16 + 1, LEVELS * NARROW * 16), f"(0{{{NARROW * 16}}})+$", "")
    return sums.select(F.col("g").alias(named), F.when(
        F.size("sums") > 0, F.concat(F.substring(out, 1, WIDE * 16), levels)).alias("fingerprint"))


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


def _row(doc_id: object, text: str, own: bytes, following: str, after: bytes, known: dict[str, bytes]) -> tuple:
    changed = edited_text(text, following)
    edited = fingerprint(changed, known)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), edited.hex(),
            likeness(own, edited), likeness(own, after))


@dataclass
class Ranges:
    """Ranges of (id, hash of the text) in descending order, from 0; null ids come last."""
    cuts: np.ndarray   # ids, ascending
    share: np.ndarray  # ranges that each of them has for itself
    first: np.ndarray  # first range of each cut, counted upwards; the ids below it have the one before
    total: int
    nulls: int

    @classmethod
    def of(cls, quantiles: list[int], nulls: int) -> Ranges:
        """An id that is several quantiles has as many ranges."""
        cuts, count = np.unique(np.array(quantiles, np.int64), return_counts=True)
        share = np.where(count > 1, count, 0)
        first = np.cumsum(share + 1) - share
        return cls(cuts, share, first, int(first[-1] + share[-1] if len(cuts) else 0) + 1, max(1, nulls))

    def number(self, ids: pa.Array, marks: pa.Array) -> np.ndarray:
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        value = ids.fill_null(0).to_numpy()
        # the hash as a share of its whole range
        part = (marks.to_numpy().astype(np.float64) + 2.0 ** 63) / 2.0 ** 64
        at = np.searchsorted(self.cuts, value)
        up = np.append(self.first - 1, self.total - 1)[at]
        if len(self.cuts):
            near = np.minimum(at, len(self.cuts) - 1)
            own = (self.cuts[near] == value) & (self.share[near] > 0) & (at < len(self.cuts))
            up = np.where(own, self.first[near] + np.minimum(part * self.share[near], self.share[near] - 1).astype(np.int64), up)
        last = self.nulls - 1 - np.minimum(part * self.nulls, self.nulls - 1).astype(np.int64)
        return np.where(missing, self.total + last, self.total - 1 - up)


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint, edited text and likeness of every document and the next in descending id.

    The ids are cut into ranges at their quantiles (numbers only), the
    texts are dealt to the ranges in one shuffle, and each range also gets
    the first document of the range after it, so every pair of neighbours
    meets in one task and none sees more than its range. An id that many rows
    share, or none at all, has several ranges, by the hash of the text.

    Sets the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` to at most
    ``BATCH_BYTES`` (and leaves it so, as the result is computed later).
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    kind = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # about eight ranges a task, so that dealing ranges by hash stays even; their bounds are as few numbers
    wanted = 8 * parts
    cuts, n, known = df.select(
        F.percentile_approx(F.col(id_col).cast("bigint"), [k / wanted for k in range(1, wanted)], 8 * wanted),
        F.count("*"), F.count(id_col)).first()
    if not n:
        return spark.createDataFrame([], _SCHEMA.format(id_col=id_col, kind=kind))
    ranges = Ranges.of(cuts or [], -(-wanted * (n - known) // n))

    def number(ids: pa.Array, marks: pa.Array) -> pa.Array:
        return pa.array(ranges.number(ids, marks), pa.int32())

    placed = docs.withColumn("range", F.arrow_udf(number, "int")(F.col("id").cast("bigint"), F.col("mark")))
    heads = {r["range"]: r["head"] for r in placed.groupBy("range").agg(F.max(F.struct("id", "mark")).alias("head")).collect()}
    order = sorted(heads)
    before = dict(zip(order[1:] + order[:1], order))  # the range that needs this one's head; the last needs the first's
    table = spark.createDataFrame([(r, before[r], *heads[r]) for r in order],
                                  f"range int, before int, head {kind}, head_mark bigint")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("extra"))
    dealt = (placed.join(F.broadcast(table), "range")
             .select("id", "text", "mark", F.explode(F.when(
                 F.col("id").eqNullSafe(F.col("head")) & (F.col("mark") == F.col("head_mark")),
                 F.array(own, F.struct(F.col("before").alias("range"), F.lit(True).alias("extra"))))
                 .otherwise(F.array(own))).alias("x"))
             .select("id", "text", "mark", "x.range", "x.extra"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(_paired(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [id_type, pa.int64(), pa.string(), pa.string(),
                                                            pa.string(), pa.float64(), pa.float64()])],
                names=[id_col, *_SCHEMA_NAMES])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(df.schema[id_col].dataType)
    return (dealt.repartition(parts, "range")
            .sortWithinPartitions("range", "extra", F.col("id").desc_nulls_last(), F.col("mark").desc(), F.col("text").desc())
            .drop("mark")
            .mapInArrow(trimmed(run), _SCHEMA.format(id_col=id_col, kind=kind)))


_SCHEMA = ("{id_col} {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_SCHEMA_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _paired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """A result row for each document, with the row that follows it in its range."""
    held = None  # (range, id, text, fingerprint, digests of its paragraphs)
    parts = (batch.slice(a, b - a) for batch in batches for a, b in slices(batch[1]))
    for part in parts:
        for doc_id, text, at, extra in zip(*(c.to_pylist() for c in part.columns)):
            digests: dict[str, bytes] = {}
            own = fingerprint(text, digests)
            if held is not None and held[0] == at:
                yield _row(*held[1:4], text, own, held[4] | digests)
                held = None
            if not extra:
                held = (at, doc_id, text, own, digests)


def _grouped(rows: Iterable[tuple], n: int = 256) -> Iterator[list[tuple]]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == n:
            yield out
            out = []
    if out:
        yield out
