"""Row and group quality rules: null drop, defaults, keep-priced, the
whole-ticker price gate, any/all tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Drop rows with a null in any required column."""
    return df.na.drop(how="any", subset=list(required))


def default_missing(df: DataFrame, defaults: dict[str, object],
                    types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Add absent optional columns with their default; fill nulls of present
    ones. Run after ``drop_incomplete`` so only absent values get defaults."""
    types = types or {}
    for name, value in defaults.items():
        dtype = types.get(name, T.DoubleType())
        if name in df.columns:
            df = df.withColumn(name, F.coalesce(F.col(name).cast(dtype), F.lit(value).cast(dtype)))
        else:
            df = df.withColumn(name, F.lit(value).cast(dtype))
    return df


def keep_priced(df: DataFrame, price: str = "adjusted_close") -> DataFrame:
    return df.where(F.col(price).isNotNull())


def gate_groups(df: DataFrame, keys, price: str = "adjusted_close") -> DataFrame:
    """Per group: passes when every price is > 0 (nulls ignored)."""
    return (df.groupBy(*_keys(keys))
              .agg(F.coalesce(F.bool_and(F.col(price) > 0), F.lit(True)).alias("_passes")))


def price_gate(df: DataFrame, keys, price: str = "adjusted_close",
               bounded_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Whole-group gate: a group with any price <= 0 is rejected entirely.

    Returns (passed rows, rejected group keys).

    Default (groups of any size): the per-group verdict is a partial
    aggregate (one row per group); rows are kept by a semi join against the
    failing groups, null-safe in its keys, broadcast or skew-split by Spark from
    measured sizes. No window holds a whole group in one task.

    ``bounded_groups=True`` (e.g. quarterly bars per ticker: at most one row
    per calendar quarter): the verdict is a window over the group, which
    shares its exchange with the returns windows that follow instead of
    computing the input twice.
    """
    if bounded_groups:
        w = Window.partitionBy(*_keys(keys))
        judged = df.withColumn("_passes", F.coalesce(
            F.bool_and(F.col(price) > 0).over(w), F.lit(True)))
        bad = judged.where(~F.col("_passes")).select(*_keys(keys)).distinct()
        return judged.where(F.col("_passes")).drop("_passes"), bad
    verdict = gate_groups(df, keys, price)
    bad = verdict.where(~F.col("_passes")).select(*_keys(keys))
    failed = bad.select(*[F.col(k).alias(f"_bad_{i}") for i, k in enumerate(_keys(keys))])
    same = [df[k].eqNullSafe(failed[f"_bad_{i}"]) for i, k in enumerate(_keys(keys))]
    return df.join(failed, same, "left_anti"), bad


def any_of(cond: Column) -> Column:
    return F.coalesce(F.bool_or(cond), F.lit(False))


def all_of(cond: Column) -> Column:
    return F.coalesce(F.bool_and(cond), F.lit(True))
