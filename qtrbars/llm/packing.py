"""Operator 1: variable-capacity best-fit packing of documents into sequences.

Several sequence lengths are permitted, each with a cost (by default its
tokens, a share that grows with their square as attention does, and what a
sequence costs in itself, so that no length is best for all). Pieces are
packed longest first; a piece goes to the open bin it leaves least room in,
and if none has room a new bin is opened. At the end each bin is downsized to
the cheapest permitted length that holds its contents. The lengths are optimised
jointly: the packing is repeated with a bin of each permitted length
opened for the pieces it holds (longer ones open the cheapest that holds
them), and once with that of least cost per token for each piece; the plan
with the least total cost stands.

Sizes are counted once and written with a row number, by a hash of which
pieces are dealt into groups of about ``group_pieces``, each packed on its
own. So no task grows with the corpus or with an id that many rows share;
what is lost is the unfilled end of a few bins a group. Only ids and lengths
are shuffled.

Defined results: a document longer than the largest length is cut into pieces
of that length and a rest; a document of no tokens (or null) gets one row
with null bin columns; rows with a null or repeated id are packed each on its own; an empty
input gives no rows. Equal lengths are
taken by id, then by piece.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jaccard import written
from .text import slices, text_buffer, trimmed, word_bounds

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence beside its tokens, and the length at which attention costs as much as they do.
SEQUENCE, ATTENTION = 32, 16384
GROUP_PIECES = 8192


def default_costs(lengths) -> dict[int, float]:
    return {int(n): n + n * n / ATTENTION + SEQUENCE for n in lengths}


def _pack(sizes: list[int], costs: dict[int, float], opened: int | None) -> tuple[list[int], list[int], float]:
    """(bin of each size, load of each bin, cost), sizes in descending order.

    ``opened``: the length of new bins for the pieces it holds; null for that of
    least cost per token.
    """
    lengths = sorted(costs)
    opening: dict[int, int] = {}
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    bins, loads = [], []
    for size in sizes:
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            first = bisect.bisect_left(lengths, size)
            if first not in opening:
                fit = lengths[first:]
                opening[first] = (min(fit, key=lambda n: (costs[n] / n, n)) if opened is None
                                  else opened if opened >= size else downsized(size, costs))
            room, b = opening[first], len(loads)
            loads.append(0)
        loads[b] += size
        bins.append(b)
        if room > size:
            bisect.insort(free, (room - size, b))
    return bins, loads, sum(costs[downsized(x, costs)] for x in loads)


def downsized(load: int, costs: dict[int, float]) -> int:
    """The cheapest permitted length that holds the load."""
    return min((n for n in costs if n >= load), key=lambda n: (costs[n], n))


def best_fit(sizes: list[int], costs: dict[int, float]) -> tuple[list[int], list[int]]:
    """(bin of each size, capacity of each bin); sizes in descending order, none above the largest length."""
    if not sizes:
        return [], []
    bins, loads, _ = min(plans(sizes, costs), key=lambda p: p[2])
    return bins, [downsized(x, costs) for x in loads]


def plans(sizes: list[int], costs: dict[int, float]) -> list[tuple[list[int], list[int], float]]:
    """The packings that are held against each other; of the lengths that no piece fits, none opens."""
    useful = [n for n in sorted(costs) if n >= sizes[-1]]
    return [_pack(sizes, costs, n) for n in [None, *useful]]


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens): whitespace-separated words of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch[1]):
                part = batch.slice(a, b - a)
                data, off = text_buffer(part[1])
                rows = word_bounds(data, off)[2]
                n = np.bincount(rows, minlength=len(off) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part[0], pa.array(n)], names=["id", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        trimmed(run), f"id {kind}, n_tokens bigint")


def pack(sized: DataFrame, lengths=LENGTHS, costs: dict[int, float] | None = None,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack rows of (id, n_tokens).

    Returns (id, piece, piece_start, piece_tokens, group_id, bin, bin_offset,
    bin_tokens, capacity), one row a piece. A bin is named by (group_id, bin).
    """
    costs = costs or default_costs(lengths)
    if not costs or min(costs) < 1 or min(costs.values()) < 0:
        raise ValueError("permitted lengths are positive, their costs not negative")
    most = max(costs)
    kind = sized.schema["id"].dataType.simpleString()
    sized = written(sized.select("id", "n_tokens", F.monotonically_increasing_id().alias("row")), "packing-sizes")
    n = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("bigint")
    pieces = (sized.select("id", "row", n.alias("n"))
              .select("id", "row", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("n") - 1, F.lit(0)),
                                                      F.lit(most).cast("bigint"))).alias("piece_start"))
              .select("id", "row", (F.col("piece_start") / most).cast("int").alias("piece"), "piece_start",
                      F.least(F.col("n") - F.col("piece_start"), F.lit(most)).alias("piece_tokens")))
    # a bounded number of groups of bounded size: one count over ids and lengths
    total = sized.select(F.sum(F.ceil(n / most) + 1)).first()[0] or 0
    groups = max(1, -(-int(total) // group_pieces))
    key = F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["piece_tokens", "id", "piece"], ascending=[False, True, True],
                                  kind="stable", ignore_index=True)
        full = int((group["piece_tokens"] > 0).sum())
        bins, caps = best_fit(group["piece_tokens"].tolist()[:full], costs)
        at = pd.Series(bins, dtype="int64")
        size = group["piece_tokens"].iloc[:full]
        out = group[["id", "piece", "piece_start", "piece_tokens", "group_id"]].copy()
        for name, value in (("bin", at), ("bin_offset", size.groupby(at).cumsum() - size),
                            ("bin_tokens", size.groupby(at).transform("sum")),
                            ("capacity", at.map(dict(enumerate(caps))))):
            out[name] = value.astype("Int64").reindex(out.index)
        return out

    return (pieces.withColumn("group_id", key).drop("row").groupBy("group_id").applyInPandas(
        run, f"id {kind}, piece int, piece_start bigint, piece_tokens bigint, group_id int, "
             "bin bigint, bin_offset bigint, bin_tokens bigint, capacity bigint"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pack whole documents, sized in words."""
    return pack(count_words(docs, id_col, text_col), **options).withColumnRenamed("id", id_col)
