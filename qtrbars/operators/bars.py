"""Daily bars -> calendar-quarter bars.

One ``groupBy(key, quarter_start)`` with declarative aggregates only, so the
aggregate runs partial (map-side) before the shuffle: a ticker that holds a
third of all daily rows still contributes at most one partial row per map task
and quarter. Ordered first/last use ``min_by``/``max_by`` on the bar date (a
plain DATE orders inside a hash aggregate; a tie-break struct falls back to a
sort-based aggregate, still partial), never ``first``/``last`` whose result
depends on arrival order after a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, quarter_end, quarter_label, quarter_start

BAR_PRICE_COLS = ["open", "high", "low", "close", "adjusted_close"]

# Column order of the canonical quarterly bar (one schema for every vendor;
# vendors without dividend/split data leave them null).
BAR_COLUMNS = ["source", "ticker", "quarter", "open", "high", "low", "close",
               "adjusted_close", "volume", "dividend_amount", "split_coefficient",
               "date", "data_load", "pct_change", "compound_return"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_coefficient_agg(x) -> Column:
    """1.0 when every split value in the group is 1, else the smallest value
    that is not 1. Nulls are ignored; an all-null group gives 1.0. Native
    expression, so the aggregate stays partial (no per-group Python)."""
    x = _c(x)
    return F.coalesce(F.min(F.when(x != F.lit(1.0), x)), F.lit(1.0)).cast("double")


def quarter_ohlcv_aggs(order: Column, actions: bool = True) -> list[Column]:
    """Aggregates of one quarter: first open, max high, min low, last close and
    adjusted close, summed volume (and dividends, split coefficient)."""
    aggs = [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.max_by("adjusted_close", order).alias("adjusted_close"),
        # an all-null group sums to 0, as the source job's frame library does;
        # a sum beyond 64 bits is null (payloads of such size are rejected before)
        F.when(F.count("volume") == 0, F.lit(0)).otherwise(F.try_sum("volume")).cast("bigint").alias("volume"),
    ]
    if actions:
        aggs += [
            F.coalesce(F.sum("dividend_amount"), F.lit(0.0)).cast("double").alias("dividend_amount"),
            split_coefficient_agg("split_coefficient").alias("split_coefficient"),
        ]
    return aggs


def quarterly_bars(daily: DataFrame, keys=("ticker",), date: str = "date",
                   order: Column | None = None, actions: bool = True) -> DataFrame:
    """Resample daily bars to calendar quarters (left-closed, calendar-aligned;
    quarters without rows are not emitted).

    ``daily`` has ``keys``, ``date`` and open/high/low/close/adjusted_close/
    volume (+ dividend_amount/split_coefficient when ``actions``).
    ``order`` orders rows inside a quarter for first/last; default the date.
    Returns keys, quarter_start, the OHLCV columns, ``date`` (quarter end) and
    ``quarter`` (``yyyyQn``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = as_date(date) if order is None else order
    bars = (daily
            .groupBy(*keys, quarter_start(date).alias("quarter_start"))
            .agg(*quarter_ohlcv_aggs(order, actions)))
    return (bars
            .withColumn("date", quarter_end("quarter_start"))
            .withColumn("quarter", quarter_label("quarter_start")))
