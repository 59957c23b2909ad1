"""Ticker universe: join, clean, remap, sample, batch, resume.

Nothing here collects to the driver. Positional operators (round-robin
batches, skip-first-n) need a global row index; ``with_global_index`` builds
one as a distributed prefix sum (range partition, per-partition counts,
offsets over the count table) instead of an unpartitioned ``row_number``
window, which would run in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tickers import keep_ticker, remap_alias

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def ticker_universe(prices: DataFrame, mapping: DataFrame, key: str = "cusip",
                    ticker: str = "ticker", keep_key: bool = False) -> DataFrame:
    """Tickers of the securities that have prices.

    DISTINCT (key, ticker) rows of ``mapping`` whose key occurs in ``prices``.
    A ticker reached through several keys appears once per key (kept, as the
    source job keeps them). The price side is deduplicated first: a partial
    aggregate, so a key holding a third of all price rows adds one row per map
    task to the shuffle; the semi join then adds no columns. AQE broadcasts
    whichever side measures small and splits skewed partitions otherwise.
    ``keep_key`` keeps the key column: it tells rows of one ticker apart, which
    positional operators need to spread a frequent ticker.
    """
    keys = prices.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return (mapping.select(key, ticker).distinct()
            .join(keys, key, "left_semi")
            .select(*([key] if keep_key else []), ticker))


def normalize_tickers(df: DataFrame, col: str = "ticker", digits: str = "any",
                      aliases: dict | None = None) -> DataFrame:
    """Drop malformed symbols (digits, '/', '*'), then rewrite aliases."""
    return (df.where(keep_ticker(col, digits=digits))
              .withColumn(col, remap_alias(col, aliases)))


def sample_tickers(df: DataFrame, n: int, seed: int = 42, col: str = "ticker") -> DataFrame:
    """Repeatable sample of ``n`` rows without replacement: the ``n`` smallest
    hashes of (seed, ticker). Plans as a per-partition top-n and one merge of
    at most n rows per partition (the limit is the feature here)."""
    h = F.md5(F.concat(F.lit(f"{seed}-"), F.col(col).cast("string")))
    return df.orderBy(h, F.col(col)).limit(n)


def with_global_index(df: DataFrame, order: list, out: str = "row_index",
                      partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` over the whole DataFrame.

    Rows are range-partitioned on the order (a fixed partition count, so AQE
    does not regroup them), sorted inside partitions and stamped with their
    partition and position, then checkpointed (reliable, in the shared
    checkpoint folder): the per-partition counts and the rows then read the
    same files, so range bounds drawn by sampling cannot differ between the
    two uses, and a lost executor does not change the numbering. Each row's
    index is its partition's offset plus its place in the partition; offsets
    come from a table with one row per partition (size bounded by the
    partition count), broadcast back. Ties in ``order`` are broken by a hash
    of the whole row, so a frequent key spreads over partitions as far as its
    rows differ, and the numbering of different rows is repeatable.
    """
    from ..session import shared_dir
    shared_dir(df.sparkSession)
    spark: SparkSession = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    order = [*order, F.xxhash64(*df.columns)]
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
                    .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                    .checkpoint(eager=True))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # window over the per-partition count table only: one row per partition
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_part")
                  .withColumn(out, F.col("_off") + F.col("_pos"))
                  .drop("_mid", "_part", "_pos", "_off"))


def round_robin_batches(df: DataFrame, n_batches: int, order: list,
                        out: str = "batch") -> DataFrame:
    """Element i (in ``order``) goes to batch i mod n_batches."""
    idx = with_global_index(df, order, out="_i")
    return idx.withColumn(out, F.pmod(F.col("_i"), F.lit(n_batches)).cast("int")).drop("_i")


def skip_first(df: DataFrame, n: int, order: list) -> DataFrame:
    """All rows after the first ``n`` in ``order`` (a resume point)."""
    idx = with_global_index(df, order, out="_i")
    return idx.where(F.col("_i") >= n).drop("_i")


def distinct_tickers(df: DataFrame, col: str = "ticker") -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def pending_tickers(universe: DataFrame, done: DataFrame, col: str = "ticker") -> DataFrame:
    """Universe minus tickers already handled (stored bars or registered as
    not available). Both sides are deduplicated by partial aggregates first,
    then anti-joined."""
    return distinct_tickers(universe, col).join(distinct_tickers(done, col), col, "left_anti")


def ticker_col(prefix: str, key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), k.cast("string"))
