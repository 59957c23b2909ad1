"""Reshape: vendor column names, wide (ticker x field) tables -> long rows."""

from __future__ import annotations

import re
from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_name(name: str) -> str:
    """Vendor field name -> column name: lower case, spaces to underscores."""
    return name.lower().replace(" ", "_")


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_columns(df: DataFrame, rename: dict | None = None,
                      drop: tuple = ()) -> DataFrame:
    """Normalise every column name, drop the listed ones when present (no-op
    otherwise), then apply ``rename``. Metadata only: no data is touched."""
    df = df.toDF(*[normal_name(c) for c in df.columns])
    df = df.drop(*[c for c in drop if c in df.columns])
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return df


def split_wide_columns(columns, index: str, sep: str = "|") -> "OrderedDict[str, dict]":
    """Column names ``TICKER<sep>Field`` -> {ticker: {normal field: column}}."""
    out: OrderedDict[str, dict] = OrderedDict()
    for c in columns:
        if c == index or sep not in c:
            continue
        ticker, field = c.split(sep, 1)
        out.setdefault(ticker, OrderedDict())[normal_name(field)] = c
    return out


def wide_to_long(wide: DataFrame, index: str = "Date", sep: str = "|",
                 fields: list[str] | None = None, complete_flag: str = "_complete") -> DataFrame:
    """Wide table (one row per date, one column per ticker and field) -> one
    row per (ticker, date) with one column per field.

    ``unpivot`` turns every cell into a (date, column name, value) row, the
    column name is split into ticker and normalised field, and one
    ``groupBy(ticker, date)`` puts the fields back side by side with a
    conditional ``max`` per field (each cell is unique, so ``max`` is just a
    pick; the aggregate runs partial before its shuffle). The expression per
    input column stays trivial, so planning is linear in the number of columns
    (a vendor batch of a few thousand tickers is tens of thousands of columns;
    one struct per ticker in a single projection took minutes to plan).
    Only column names are read on the driver. Fields a ticker lacks are null;
    ``complete_flag`` is true when every field the ticker has is non-null
    (the per-ticker "drop rows with any null" test).
    """
    groups = split_wide_columns(wide.columns, index, sep)
    if not groups:
        raise ValueError("no TICKER|Field columns found")
    if fields is None:
        fields = list(OrderedDict.fromkeys(f for g in groups.values() for f in g))
    value_cols = [c for g in groups.values() for c in g.values()]
    cells = wide.unpivot([index], value_cols, "_col", "_value")
    s = re.escape(sep)
    cells = cells.select(
        _q(index).try_cast("date").alias("date"),
        F.regexp_extract("_col", f"^(.*?){s}", 1).alias("ticker"),
        F.replace(F.lower(F.regexp_extract("_col", f"^.*?{s}(.*)$", 1)),
                  F.lit(" "), F.lit("_")).alias("_field"),
        # a malformed cell or NaN counts as missing
        F.nanvl(F.col("_value").try_cast("double"), F.lit(None).cast("double")).alias("_value"))
    return fields_side_by_side(cells, fields, complete_flag)


def fields_side_by_side(cells: DataFrame, fields: list[str], complete_flag: str = "_complete") -> DataFrame:
    """Cells (ticker, date, _field, _value) -> one row per (ticker, date). Each cell is
    unique, so ``max`` is just a pick, and the aggregate runs partial before its shuffle."""
    aggs = [F.max(F.when(F.col("_field") == f, F.col("_value"))).alias(f) for f in fields]
    aggs.append((F.count("_value") == F.count(F.lit(1))).alias(complete_flag))
    return (cells.groupBy("ticker", "date").agg(*aggs)
                 .select("ticker", "date", *fields, complete_flag))
