"""Per-ticker return measures over quarterly rows.

The windows partition by ticker and order by quarter. Their frames hold one
row per quarter of one ticker, so a partition's size is bounded by the length
of the calendar (about 400 rows for a century), not by the data volume: a hot
ticker with a third of all daily rows still has only its quarters here.
Apply these to bars, not to daily rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _window(keys, order):
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*_keys(keys)).orderBy(*order)


def with_pct_change(df: DataFrame, keys=("ticker",), order="quarter_start",
                    price: str = "adjusted_close", out: str = "pct_change",
                    method: str = "diff") -> DataFrame:
    """Percent change against the previous row, x100, rounded to 2 places.

    ``method='diff'``: forward-fill the price, then (p - prev) / prev, comparing
    with the most recent non-null price (frame-library semantics).
    ``method='ratio'``: p / prev - 1 on the raw rows (the other library).
    Division by zero gives null, never an error.
    """
    w = _window(keys, order)
    if method == "diff":
        filled = F.last(price, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # each window value is named once so it is computed once
        df = df.withColumn("_filled", filled).withColumn("_prev", F.lag("_filled").over(w))
        pct = F.try_divide(F.col("_filled") - F.col("_prev"), F.col("_prev"))
        return df.withColumn(out, F.round(pct * 100, 2)).drop("_filled", "_prev")
    if method == "ratio":
        df = df.withColumn("_prev", F.lag(price).over(w))
        pct = F.try_divide(F.col(price), F.col("_prev")) - 1
        return df.withColumn(out, F.round(pct * 100, 2)).drop("_prev")
    raise ValueError("method must be 'diff' or 'ratio'")


def with_compound_return(df: DataFrame, keys=("ticker",), order="quarter_start",
                         price: str = "adjusted_close", out: str = "compound_return") -> DataFrame:
    """Return since the ticker's first row, x100, rounded to 2 places. A null
    first price makes the series null (no skipping of nulls)."""
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # named once so the window value is computed a single time
    df = df.withColumn("_base", F.first(price).over(w))
    ret = F.try_divide(F.col(price) - F.col("_base"), F.col("_base")) * 100
    return df.withColumn(out, F.round(ret, 2)).drop("_base")


def with_returns(df: DataFrame, keys=("ticker",), order="quarter_start",
                 price: str = "adjusted_close", method: str = "diff") -> DataFrame:
    df = with_pct_change(df, keys, order, price, method=method)
    return with_compound_return(df, keys, order, price)


def trading_span(bars: DataFrame, keys=("ticker",), price: str = "adjusted_close",
                 label: str = "quarter") -> DataFrame:
    """First and last quarter that carries a price, per key (null when none).
    Labels ``yyyyQn`` are compared as the number ``yyyyn``, which keeps the
    partial aggregate a hash aggregate (text would make it sort its input)."""
    n = F.when(F.col(price).isNotNull(), F.replace(F.col(label), F.lit("Q"), F.lit("")).cast("int"))
    spans = bars.groupBy(*_keys(keys)).agg(F.min(n).alias("_first"), F.max(n).alias("_last"))

    def text(c):
        return F.concat(F.floor(F.col(c) / 10).cast("string"), F.lit("Q"), (F.col(c) % 10).cast("string"))
    return spans.select(*_keys(keys), text("_first").alias("first_quarter"), text("_last").alias("last_quarter"))
