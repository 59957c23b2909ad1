"""Operator 7: exact top-k search by multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... equal segments; of each segment the mean and
deviation are kept. With them the squared distance of two vectors is at least

    sum over segments of n * ((mean_q - mean_x)**2 + (dev_q - dev_x)**2)

and since <q, x> = (|q|**2 + |x|**2 - distance**2) / 2 a lower bound of the
distance is an upper bound of the inner product. A query's candidates are
held against its k-th best score so far, coarse segments first, finer ones
for those left, and exact integer products for the survivors.

Vectors lie in blocks of bounded size: by the nearest of a bounded sample of
pivots, then by hash. A block's envelope, the least and greatest of its rows'
statistics, bounds the products of two blocks. Each block of queries is held
first against the block with the greatest bound; the k-th best scores found
there are floors, and of the other pairs of blocks only those are made
whose bound reaches the floor. So vectors in clusters meet few others, while
for vectors without any structure every pair of blocks remains. Each pair is one
task's work and returns k rows a query, of which the best k stay.

Defined results: vectors that are null, or hold a null or a component that
isn't finite, take no part; a shorter vector counts as filled up with zeros;
ties go to the smaller id, then equal ids are kept as separate rows; a query id
that comes with several vectors asks with the smallest (component by component); fewer
candidates than k give fewer rows; an empty input gives no rows. Products are
those of 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .jaccard import written
from .sampling import least_by_hash

#: Rows of a block of queries and of candidates.
QUERY_BLOCK, ROW_BLOCK = 1024, 4096
#: Pairs looked at together.
PAIRS = 1 << 20
#: Most pivots, segments of an envelope, and envelopes held against each other at once.
PIVOTS, ENVELOPE, CHUNK = 1024, 8, 1024


def quantize(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as long; null where the vector takes no part."""
    sound = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(sound, F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations, times the root of the segment's length: (n, 2 * segments).

    The products of two rows' statistics then sum to the bound of their inner product.
    """
    n, d = rows.shape
    parts = rows.reshape(n, segments, d // segments)
    mean = parts.mean(axis=2)
    dev = np.sqrt(np.maximum((parts * parts).mean(axis=2) - mean * mean, 0))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(d // segments)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    sizes = vectors.str.len().to_numpy()
    flat = np.concatenate(vectors.tolist()) if len(vectors) else np.zeros(0, np.int64)
    if (sizes == width).all():
        return flat.reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Exact best k of the rows for each query, without the query's own id.

    Returns (query position, row position, score) arrays, at least the best k.
    """
    width = max(1, 1 << max(0, (queries.shape[1] - 1).bit_length()))  # a power of two, so segments halve
    q = np.zeros((len(queries), width))
    x = np.zeros((len(rows), width))
    q[:, :queries.shape[1]] = queries
    x[:, :rows.shape[1]] = rows
    levels = [1 << s for s in range(0, width.bit_length()) if 1 << s <= max(1, width // 2)][1::2] or [1]
    stats = [(segment_statistics(q, s), segment_statistics(x, s)) for s in levels]
    # rounding of the bounds, and a bound that is none where doubles can't hold the products
    slack = 1e-6 * (1 + np.abs(q).sum(axis=1).max(initial=0) * np.abs(x).max(initial=0))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, PAIRS // max(1, len(rows)))
    for at in range(0, len(queries), step):
        here = slice(at, at + step)
        bound = stats[0][0][here] @ stats[0][1].T
        own = query_ids[here, None] == ids[None, :]
        bound[own] = -np.inf
        n = min(k, len(rows))
        # first scores: the exact ones of each query's most promising rows
        first = np.argpartition(-bound, n - 1, axis=1)[:, :n]
        score = np.einsum("qd,qkd->qk", queries[here], rows[first]).astype(np.float64)
        score[np.take_along_axis(own, first, axis=1)] = -np.inf
        floor = score.min(axis=1) - slack  # the k-th best can't be less
        qi, xi = np.nonzero((bound >= floor[:, None]) & ~own)
        for a, b in stats[1:]:
            keep = np.empty(len(qi), bool)
            for s in range(0, len(qi), PAIRS // 16):
                e = slice(s, s + PAIRS // 16)
                keep[e] = np.einsum("nd,nd->n", a[at + qi[e]], b[xi[e]]) >= floor[qi[e]]
            qi, xi = qi[keep], xi[keep]
        exact = np.empty(len(qi), np.int64)
        for s in range(0, len(qi), PAIRS // 16):
            e = slice(s, s + PAIRS // 16)
            exact[e] = np.einsum("nd,nd->n", queries[at + qi[e]], rows[xi[e]])
        order = np.lexsort((ids[xi], -exact, qi))
        qi, xi, exact = qi[order], xi[order], exact[order]
        start = np.searchsorted(qi, np.arange(min(step, len(queries) - at)))
        best = np.arange(len(qi)) - start[qi] < k
        found.append((at + qi[best], xi[best], exact[best]))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))


@dataclass
class Blocks:
    """How vectors are dealt: pivots, and blocks for the vectors nearest each."""
    pivots: np.ndarray       # (pivots, width)
    rows: np.ndarray         # first block of each pivot, and one more
    queries: np.ndarray

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        far = (self.pivots ** 2).sum(axis=1) - 2 * vectors.astype(np.float64) @ self.pivots.T
        return far.argmin(axis=1)


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of a power of two components, so that segments halve."""
    return _matrix(vectors, 1 << max(0, (width - 1).bit_length()))


def _statistics(rows: np.ndarray) -> np.ndarray:
    return segment_statistics(rows.astype(np.float64), min(ENVELOPE, rows.shape[1]))


def plan_blocks(vectors: DataFrame, n: int, width: int, query_block: int, row_block: int) -> Blocks:
    """Blocks for vectors (id, v, q); what is collected is one row a pivot."""
    wanted = min(PIVOTS, max(1, n // row_block))
    spread = F.xxhash64("id", "v")
    chosen = least_by_hash(vectors.select("id", "v"), spread, wanted, ["o", "id"],
                           lambda near: near.select(F.xxhash64("id", "v").alias("o"), "id", "v"))
    pivots = _padded(pd.Series([r["v"] for r in chosen]), width).astype(np.float64)
    blocks = Blocks(pivots, np.zeros(1, np.int64), np.zeros(1, np.int64))
    counts = {r["pivot"]: r for r in _with_pivot(vectors, blocks, width).groupBy("pivot").agg(
        F.count("*").alias("n"), F.sum(F.col("q").cast("int")).alias("nq")).collect()}
    for name, size, field in (("rows", row_block, "n"), ("queries", query_block, "nq")):
        each = [-(-counts[p][field] // size) if p in counts else 0 for p in range(len(pivots))]
        setattr(blocks, name, np.concatenate([[0], np.cumsum(each)]))
    return blocks


def _with_pivot(vectors: DataFrame, blocks: Blocks, width: int) -> DataFrame:
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(blocks.nearest(_padded(v, width)), dtype="int32")

    return vectors.withColumn("pivot", F.pandas_udf(nearest, "int")("v"))


def in_blocks(vectors: DataFrame, blocks: Blocks, width: int) -> tuple[DataFrame, DataFrame]:
    """(id, v, block) of the candidates, and of the queries, of which an id has one."""
    def dealt(df: DataFrame, first: np.ndarray) -> DataFrame:
        bounds = F.lit([int(x) for x in first])
        start, end = F.get(bounds, F.col("pivot")), F.get(bounds, F.col("pivot") + 1)
        return _with_pivot(df, blocks, width).select("id", "v", (start + F.pmod(F.xxhash64("id", "v"), end - start)).cast("int").alias("block"))

    asked = vectors.where("q").groupBy("id").agg(F.min("v").alias("v"))  # one vector a query
    return dealt(vectors.select("id", "v"), blocks.rows), dealt(asked, blocks.queries)


def envelopes(dealt: DataFrame, width: int) -> DataFrame:
    """(block, lo, hi): least and greatest statistics of each block's rows."""
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                stats = pd.DataFrame(_statistics(_padded(f["v"], width))).groupby(f["block"].to_numpy())
                lo, hi = stats.min().stack(), stats.max().stack()
                yield pd.DataFrame({"block": lo.index.get_level_values(0), "k": lo.index.get_level_values(1),
                                    "lo": lo.to_numpy(), "hi": hi.to_numpy()})

    sides = (dealt.select("v", "block").mapInPandas(partial, "block int, k int, lo double, hi double")
             .groupBy("block", "k").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return sides.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("k", "lo", "hi"))).alias("s")).select(
        "block", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))


def _bounds(q: pd.DataFrame, x: pd.DataFrame) -> np.ndarray:
    """Greatest product that a row of each query block can have with one of each other block."""
    ql, qh, xl, xh = (np.stack(f[c].to_numpy()) for f in (q, x) for c in ("lo", "hi"))
    total = np.zeros((len(q), len(x)))
    for k in range(ql.shape[1]):
        corners = [np.outer(a[:, k], b[:, k]) for a in (ql, qh) for b in (xl, xh)]
        total += np.maximum.reduce(corners)
    return total + 1e-6 * (1 + np.abs(total))


def _held(of_queries: DataFrame, of_rows: DataFrame, each, schema: str) -> DataFrame:
    """``each(query blocks, row blocks)`` for all pairs of blocks of at most ``CHUNK`` envelopes."""
    def chunked(df: DataFrame) -> tuple[DataFrame, int]:
        n = -(-df.count() // CHUNK) or 1
        return df.withColumn("c", F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")), n

    (q, nq), (x, nx) = chunked(of_queries), chunked(of_rows)
    q = q.withColumnRenamed("c", "qc").withColumn("xc", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))
    x = x.withColumnRenamed("c", "xc").withColumn("qc", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) and len(b):
            return each(a, b)
        return pd.DataFrame({c.split()[0]: pd.Series(dtype="float64") for c in schema.split(", ")})

    return q.groupBy("qc", "xc").cogroup(x.groupBy("qc", "xc")).applyInPandas(run, schema)


def promising(of_queries: DataFrame, of_rows: DataFrame) -> DataFrame:
    """(qb, xb): for each query block the block with the greatest bound."""
    def each(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        bound = _bounds(q, x)
        best = bound.argmax(axis=1)
        return pd.DataFrame({"qb": q["block"].to_numpy(), "xb": x["block"].to_numpy()[best],
                             "bound": bound[np.arange(len(q)), best]})

    found = _held(of_queries, of_rows, each, "qb int, xb int, bound double")
    return found.groupBy("qb").agg(F.max_by("xb", "bound").alias("xb"))


def reaching(of_queries: DataFrame, of_rows: DataFrame, floors: DataFrame) -> DataFrame:
    """(qb, xb): the pairs of blocks whose bound reaches the query block's floor (null: none known)."""
    def each(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        i, j = np.nonzero(_bounds(q, x) >= q["floor"].fillna(-np.inf).to_numpy()[:, None])
        return pd.DataFrame({"qb": q["block"].to_numpy()[i], "xb": x["block"].to_numpy()[j]})

    known = of_queries.join(floors.withColumnRenamed("qb", "block"), "block", "left")
    return _held(known, of_rows, each, "qb int, xb int")


def search_cells(queries: DataFrame, rows: DataFrame, cells: DataFrame, width: int, k: int) -> DataFrame:
    """(qb, query_id, vec_id, score): the best k rows of each cell (qb, xb) for its queries."""
    def cell(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        names = ["qb", "query_id", "vec_id", "score"]
        if not len(q) or not len(x):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        qid, xid = q["id"].to_numpy(np.int64), x["id"].to_numpy(np.int64)
        a, b, score = search_block(qid, _matrix(q["v"], width), xid, _matrix(x["v"], width), k)
        return pd.DataFrame(dict(zip(names, (np.full(len(a), q["qb"].iloc[0]), qid[a], xid[b], score))))

    asked = queries.withColumnRenamed("block", "qb").join(cells, "qb")
    held = rows.withColumnRenamed("block", "xb").join(cells, "xb")
    return asked.groupBy("qb", "xb").cogroup(held.groupBy("qb", "xb")).applyInPandas(
        cell, "qb int, query_id bigint, vec_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, id, score) of each query's best k rows."""
    vectors = (df.select(F.col(id_col).cast("bigint").alias("id"), quantize(F.col(vec_col)).alias("v"),
                         F.coalesce(is_query, F.lit(False)).alias("q"))
               .where("id is not null and v is not null"))
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 1, 1)
    if not n:
        return df.sparkSession.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score bigint")
    rows, queries = in_blocks(vectors, plan_blocks(vectors, n, width, query_block, row_block), width)
    of_rows, of_queries = written(envelopes(rows, width), "topk-rows"), written(envelopes(queries, width), "topk-queries")
    # the k-th best scores found in the most promising block are what all others have to reach
    asked = written(queries, "topk-asked")
    first = search_cells(asked, rows, promising(of_queries, of_rows), width, k)
    kth = _ranked(first, k).groupBy("qb", "query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    each = asked.select(F.col("block").alias("qb"), F.col("id").alias("query_id")).join(kth, ["qb", "query_id"], "left")
    floors = each.groupBy("qb").agg(F.min(F.when(F.col("n") >= k, F.col("kth")).otherwise(F.lit(-2 ** 63))).alias("kth")).select(
        "qb", F.when(F.col("kth") > -2 ** 63, F.col("kth").cast("double")).alias("floor"))
    cells = written(reaching(of_queries, of_rows, floors), "topk-cells")
    return _ranked(search_cells(asked, rows, cells, width, k), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
