"""Operator 3: n-gram Jaccard join by vertical partitioning.

A document's set holds its distinct five-word shingles (A-Z lowered), told
apart by 64-bit hashes. Documents link when 100 * intersection >= 75 * union.
Shingles have a global order, that of their hashes; it is cut into fragments,
and a pair's overlap is counted in each fragment alone and summed per pair.
Which pairs are counted is found by a second order, rare before frequent.

1. Documents with equal sets are one class, stood for by its smallest id.
2. A count-min sketch over all documents says which shingles are met once
   (they match nothing), and how frequent the others are.
3. A pair that links must share one of the first n - ceil(0.75 n) + 1
   shingles in that second order. Those that aren't met once are the postings.
   The sketch lets through what shares cells by chance, in a large input nearly all;
   so the first shingles alone are counted again, and only those met twice are posted.
4. Stars: within a shingle's documents of like size, each is held against the
   smallest id only; their partial overlaps, summed over fragments, pick one
   partner a document (two, as sizes are banded twice). Exact overlaps of
   those pairs give links, links give components.
5. The rest: every pair that shares a posting, lies in two components and
   could reach the threshold by its sizes and places, exactly. A group of
   near copies is mostly joined by then, so its pairs aren't made.

Before overlaps are counted, pairs go that share too few of their first
shingles to link; sets are made of the texts of what is left alone.

Links within a component that step 4 joined aren't listed; every class is
still held against all it could link with, so components are exact.

Defined results: text without words (or null) has an empty set and links with
nothing; one to four words are one shingle; a null id has its set's size and
a null component; rows with one id are one document, for which its largest
set counts (of equal sizes, that with the greatest hash) and each row's own
size is given; an empty input gives no rows.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import sketch
from .components import components
from .joins import join_heavy
from .text import lower_ascii, slices, splitmix, text_buffer, trimmed, window_hash, word_bounds, word_hashes

WORDS = 5
#: Estimated documents from which a shingle counts as repeated, common, frequent.
LEVELS = (2, 32, 1024)
#: Fragments of the order in which overlaps are counted.
FRAGMENTS = 8
#: Shingles a text from which, on average, texts are sorted one by one.
LONG_ROW = 16
#: Cells for each id of which the texts are sought, and the least width of their bits.
CELLS_EACH, LEAST_BITS = 8, 16


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted by both."""
    data, off = text_buffer(texts)
    data = lower_ascii(data)
    starts, ends, rows = word_bounds(data, off)
    words = word_hashes(data, starts, ends)
    at = np.flatnonzero(rows[:max(0, len(rows) - WORDS + 1)] == rows[WORDS - 1:])
    row, value = rows[at], window_hash(words, WORDS)[at]
    # one to four words: their whole sequence
    count = np.bincount(rows, minlength=len(off) - 1)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        first = np.searchsorted(rows, short)
        total = splitmix(count[short].astype(np.uint64))
        for k in range(WORDS - 1):
            has = count[short] > k
            total[has] = splitmix(total[has] + words[first[has] + k])
        row, value = np.concatenate([row, short]), np.concatenate([value, total])
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    _sort_within(row, value)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _sort_within(row: np.ndarray, value: np.ndarray) -> None:
    """Sorts the values of each row in place; ``row`` is sorted."""
    edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
    if len(value) < LONG_ROW * len(edges):
        value[:] = value[np.lexsort((value, row))]
        return
    edges = edges.tolist()
    for a, b in zip(edges, edges[1:]):
        value[a:b].sort()


def _sums(row: np.ndarray, value: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each row's set, as signed numbers."""
    total = np.zeros(n, np.uint64)
    np.add.at(total, row, splitmix(value ^ np.uint64(0x5DEECE66D * seed)))
    return total.view(np.int64)


def _posed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))


def set_sizes(posed: DataFrame) -> DataFrame:
    """(doc, n, f1, f2): the size and a 128-bit hash of each document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch[1]):
                part = batch.slice(a, b - a)
                row, value = shingles(part[1])
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [part[0], pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                     pa.array(_sums(row, value, n, 1)), pa.array(_sums(row, value, n, 2))],
                    names=["doc", "n", "f1", "f2"])

    return posed.mapInArrow(trimmed(run), "doc bigint, n bigint, f1 bigint, f2 bigint")


def prefix_length(n):
    """Of sets of n shingles that link, one of the first so many is shared, in any order."""
    return n - (3 * n + 3) // 4 + 1


def _firsts(part: pa.RecordBatch, levels: list[sketch.Bits]) -> tuple[np.ndarray, ...]:
    """(token, id, n, f1, f2, pos): the first shingles of the sets of (id, text), rare before frequent, less those met once.

    Of equal sets only the smallest id's posts.
    """
    ids = part[0].to_numpy()
    row, value = shingles(part[1])
    size = np.bincount(row, minlength=len(ids))
    f1, f2 = _sums(row, value, len(ids), 1), _sums(row, value, len(ids), 2)
    order = np.lexsort((ids, f2, f1, size))
    new = np.ones(len(order), bool)
    new[1:] = ((f1[order][1:] != f1[order][:-1]) | (f2[order][1:] != f2[order][:-1])
               | (size[order][1:] != size[order][:-1]))
    posts = np.zeros(len(ids), bool)
    posts[order[new]] = True
    here = posts[row]
    row, value = row[here], value[here]
    level = sketch.levels(levels, value)
    order = np.argsort(row * (len(levels) + 1) + level, kind="stable")  # sorted by hash within a row
    row, value, level = row[order], value[order], level[order]
    pos = np.arange(len(row)) - np.searchsorted(row, row)
    n = size[row]
    at = np.flatnonzero((pos < prefix_length(n)) & (level > 0))
    return value[at], ids[row[at]], n[at], f1[row[at]], f2[row[at]], pos[at]


def postings(posed: DataFrame, cell_bits: int = sketch.CELL_BITS) -> DataFrame:
    """(token, id, n, f1, f2, pos): the first shingles of each set that others have among their first.

    Of documents with equal sets in one slice of text only the smallest id posts. Shingles met once
    that the first sketch lets through, nearly all in a large input, are
    found by a count of the first shingles alone.
    """
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for a, b in slices(batch[1]):
            yield shingles(batch[1].slice(a, b - a))[1]

    bits = sketch.over(sketch.partition_sketches(posed, hashes, cell_bits), list(LEVELS), cell_bits)
    marks = sketch.shared(posed, bits)

    def firsts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for a, b in slices(batch[1]):
            yield _firsts(batch.slice(a, b - a), marks.value)[0]

    met = sketch.shared(posed, sketch.met(posed, firsts, 2, cell_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch[1]):
                found = _firsts(batch.slice(a, b - a), marks.value)
                at = np.flatnonzero(met.value.holds(found[0]))
                value, ids, n, f1, f2, pos = (x[at] for x in found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(ids), pa.array(n.astype(np.int64)), pa.array(f1),
                     pa.array(f2), pa.array(pos.astype(np.int32))],
                    names=["token", "id", "n", "f1", "f2", "pos"])

    return posed.mapInArrow(trimmed(run), "token bigint, id bigint, n bigint, f1 bigint, f2 bigint, pos int")


def segments(posed: DataFrame) -> DataFrame:
    """(doc, fragment, n, seg): each set cut at the fragments' bounds of the order of hashes.

    ``posed`` has, beside id and text, the n, f1 and f2 of the set that counts for
    the id; rows with another set are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch[1]):
                part = batch.slice(a, b - a)
                ids = part[0].to_numpy()
                row, value = shingles(part[1])
                n = np.bincount(row, minlength=len(ids))
                f1, f2 = _sums(row, value, len(ids), 1), _sums(row, value, len(ids), 2)
                counts = (n == np.asarray(part["n"])) & (f1 == np.asarray(part["f1"])) & (f2 == np.asarray(part["f2"]))
                row, value = row[counts[row]], value[counts[row]]
                fragment = (value >> np.uint64(61)).astype(np.int64)  # sorted by hash, so in order
                cell = row * FRAGMENTS + fragment
                edge = np.append(np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else 0,
                                 len(cell))
                at = edge[:-1][:len(edge) - 1] if len(cell) else edge[:0]
                offsets = np.append(at, len(cell)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row[at]].astype(np.int64)), pa.array(fragment[at].astype(np.int32)),
                     pa.array(n[row[at]].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(value.view(np.int64)))],
                    names=["doc", "fragment", "n", "seg"])

    return posed.mapInArrow(trimmed(run), "doc bigint, fragment int, n int, seg array<bigint>")


def enough(overlap: Column, a: Column, b: Column) -> Column:
    """100 * overlap >= 75 * union."""
    return 7 * overlap >= 3 * (a + b)


def heads(posts: DataFrame) -> DataFrame:
    """(doc, n, head): the postings of each document together."""
    return posts.groupBy("doc").agg(F.max("n").alias("n"), F.collect_list("token").alias("head"))


def hopeful(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """The pairs that share so many of their first shingles that they could link.

    Of two sets, let the first shingles of one end no later in the second order than
    the other's. What they share up to that end is in both heads, and after it
    the one has only its shingles that aren't among its first.
    """
    one = first.select(F.col("doc").alias("u"), F.col("n").alias("nu"), F.col("head").alias("hu"))
    other = first.select(F.col("doc").alias("v"), F.col("n").alias("nv"), F.col("head").alias("hv"))
    rest = F.floor((3 * F.greatest("nu", "nv") + 3) / 4) - 1
    return (pairs.join(one, "u").join(other, "v")
            .where(enough(F.size(F.array_intersect("hu", "hv")) + rest, F.col("nu"), F.col("nv"))).select("u", "v"))


def maybe_in(posed: DataFrame, pairs: DataFrame, n: int, cell_bits: int = sketch.CELL_BITS) -> DataFrame:
    """The rows of ``posed`` with an id in one of the ``n`` ``pairs`` (u, v), and few others."""
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for column in batch.columns:
            yield np.asarray(column).view(np.uint64)

    bits = min(max((2 * CELLS_EACH * n).bit_length(), LEAST_BITS), cell_bits)
    there = sketch.shared(posed, sketch.met(pairs, hashes, 1, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(there.value.holds(np.asarray(batch.column("id")).view(np.uint64))))

    return posed.mapInArrow(trimmed(run), posed.schema)


def verified(pairs: DataFrame, segs: DataFrame) -> DataFrame:
    """(u, v) of the pairs that link: overlaps counted by fragment, summed per pair."""
    one = segs.select(F.col("doc").alias("u"), "fragment", F.col("n").alias("nu"), F.col("seg").alias("su"))
    other = segs.select(F.col("doc").alias("v"), "fragment", F.col("n").alias("nv"), F.col("seg").alias("sv"))
    partial = (pairs.join(one, "u").join(other, ["v", "fragment"])
               .select("u", "v", "nu", "nv", F.size(F.array_intersect("su", "sv")).alias("c")))
    return (partial.groupBy("u", "v", "nu", "nv").agg(F.sum("c").alias("c"))
            .where(enough(F.col("c"), F.col("nu"), F.col("nv"))).select("u", "v"))


def star_pairs(posts: DataFrame) -> DataFrame:
    """(u, v): each document and the hub it shares most postings with, in either banding of sizes."""
    band = F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))
    banded = posts.select("token", "doc", "n", "pos", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.floor(band).alias("band")),
        F.struct(F.lit(1).alias("kind"), F.floor(band + 0.5).alias("band")))).alias("b")).select(
            "token", "doc", "b.kind", "b.band")
    hubs = (banded.groupBy("token", "kind", "band").agg(F.min("doc").alias("hub"), F.max("doc").alias("far"))
            .where("hub < far").drop("far"))
    shared = (banded.join(hubs, ["token", "kind", "band"]).where("doc <> hub")
              .groupBy("doc", "kind", "hub").agg(F.count("*").alias("c")))
    best = shared.groupBy("doc", "kind").agg(F.max_by("hub", F.struct("c", -F.col("hub"))).alias("hub"))
    return best.select(F.col("hub").alias("u"), F.col("doc").alias("v")).distinct()


def cross_pairs(posts: DataFrame) -> DataFrame:
    """(u, v) that share a posting, lie in two components and could reach the threshold.

    Which sizes and places could is found for the distinct (size, place) of a token's
    postings first, so the documents of a frequent one that can't link are
    never held against each other.
    """
    mixed = posts.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    left = posts.join(mixed.select("token"), "token", "left_semi")
    kinds = left.groupBy("token", "n", "pos").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    x, y = kinds.alias("x"), kinds.alias("y")
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    able = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.lo") < F.col("y.hi"))
                   & enough(room, F.col("x.n"), F.col("y.n"))
                   & (4 * F.least("x.n", "y.n") >= 3 * F.greatest("x.n", "y.n")))
            .select("x.token", "x.n", "x.pos", F.col("y.n").alias("m"), F.col("y.pos").alias("at")))
    one = left.join(able, ["token", "n", "pos"]).select("token", "m", "at", F.col("doc").alias("u"), F.col("component").alias("cu"))
    other = left.select("token", F.col("n").alias("m"), F.col("pos").alias("at"), F.col("doc").alias("v"), F.col("component").alias("cv"))
    return one.join(other, ["token", "m", "at"]).where("cu < cv").select("u", "v").distinct()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and not lost with an executor.

    What earlier tables were made from is garbage by then; it is collected here, as
    Spark removes the shuffles and broadcasts of a frame when it finds the frame gone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    cell_bits: int = sketch.CELL_BITS) -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    posed = _posed(docs, id_col, text_col)
    known = posed.where("id is not null")
    sizes = written(set_sizes(posed), "jaccard-sizes")
    # an id's set, were it to come with several texts: the largest, then the greatest hash
    single = sizes.where("doc is not null and n > 0").groupBy("doc").agg(
        F.max(F.struct("n", "f1", "f2")).alias("s")).select("doc", "s.*")
    single = written(single, "jaccard-single")
    classes = written(single.groupBy("n", "f1", "f2").agg(F.min("doc").alias("rep"), F.count("*").alias("docs")), "jaccard-classes")
    member = written(join_heavy(single, classes, ["n", "f1", "f2"], "docs").select("doc", "rep", "n", "f1", "f2"), "jaccard-member")
    chosen = member.where("doc = rep").drop("rep")
    # rows that come more than once, or ids with several texts
    again = sizes.where("doc is not null").count() > member.count() + sizes.where("doc is not null and n = 0").count()
    # a set that counts for no document has no class, and its postings go
    posts = postings(known, cell_bits).join(chosen, ["n", "f1", "f2"])
    posts = (posts if again else posts.where("id = doc")).select("token", "doc", "n", "pos")
    posts = written(posts.distinct() if again else posts, "jaccard-posts")
    several = posts.groupBy("token").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
    posts = written(posts.join(several.select("token"), "token", "left_semi"), "jaccard-shared")
    first_of = written(heads(posts), "jaccard-heads")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(hopeful(pairs, first_of), f"jaccard-{name}")
        n = pairs.count()
        if not n:
            return pairs
        sets = (chosen.join(pairs.select(F.explode(F.array("u", "v")).alias("doc")).distinct(), "doc", "left_semi")
                .withColumnRenamed("doc", "id"))
        segs = segments(maybe_in(known, pairs, n, cell_bits).join(sets.hint("shuffle_hash"), "id"))
        if again:
            segs = segs.dropDuplicates(["doc", "fragment"])
        return verified(pairs, written(segs, f"jaccard-{name}-segments"))

    first = components(linked(star_pairs(posts), "stars"))
    placed = posts.join(first.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc"))
    placed = written(placed, "jaccard-placed")
    label = placed.select("doc", "component").distinct()
    more = (linked(cross_pairs(placed), "crossing")
            .join(label.select(F.col("doc").alias("u"), F.col("component").alias("cu")), "u")
            .join(label.select(F.col("doc").alias("v"), F.col("component").alias("cv")), "v")
            .select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    second = components(more).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    whole = label.join(second, "component", "left").select(
        F.col("doc").alias("rep"), F.coalesce("whole", "component").alias("component"))
    named = member.select("doc", "rep").join(whole, "rep", "left").select("doc", F.coalesce("component", "rep").alias("component"))
    return sizes.join(named, "doc", "left").select(
        F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near copies, the smallest id's; null ids stay."""
    found = join_components(docs, id_col, text_col, **options)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct()
    gone = written(gone, "jaccard-gone")  # before the texts move, what found them is let go
    kept = docs.join(gone.hint("shuffle_hash"), docs[id_col] == gone["__gone"], "left_anti")
    return kept
