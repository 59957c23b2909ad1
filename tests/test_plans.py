"""Plan shape: the exchanges the design promises (AQE off to see the static plan)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

QUERIES = E.queries()


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _exchanges(plan):
    """Exchanges of the design; the guarded round-robin fan-out of a
    one-split test scan (a no-op on large inputs) is not counted."""
    return [l for l in plan.split("\n") if "Exchange" in l and "Broadcast" not in l
            and "Reused" not in l and "RoundRobinPartitioning" not in l]


@pytest.mark.parametrize("name,expected", [
    ("quarterly_bars_av", 2),      # (ticker, quarter) for the bars, ticker for the windows
    ("quarterly_bars_fmp", 2),
    ("quarterly_bars_yahoo", 2),   # gate and returns share the ticker exchange
    ("json_field_extract", 0),
    ("payload_classify", 0),       # per-row classification: no shuffle
])
def test_exchange_count(spark, name, expected):
    assert len(_exchanges(_plan(spark, name))) == expected


def test_partial_aggregation_before_shuffle(spark):
    plan = _plan(spark, "quarterly_bars_av")
    assert "partial_min_by" in plan and "partial_sum" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(spark, "quarterly_bars_av")
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    for unused in ("l_returnflag", "l_linestatus"):
        assert unused not in scan


def test_no_single_partition_exchange_on_rows(spark):
    # the global index windows only over the per-partition count table
    plan = _plan(spark, "batch_round_robin")
    singles = [l for l in plan.split("\n") if "SinglePartition" in l]
    assert len(singles) == 1


@pytest.mark.parametrize("name", ["quarterly_bars_av", "quarterly_bars_fmp", "quarterly_bars_yahoo", "pct_change",
                                  "pct_change_desc", "compound_return", "trading_span", "latest_quarters", "wide_to_long"])
def test_ties_are_picked_in_hash_aggregates(spark, name):
    assert "SortAggregate" not in _plan(spark, name)


def test_packed_order_is_the_order_of_its_parts(spark):
    from pyspark.sql import functions as F
    from qtrbars.plans import standins as S
    rows = [(h, l) for h in (0, 7, 10 ** 17, 10 ** 18 - 1) for l in (0, 3, 10 ** 18 - 1)]
    df = spark.createDataFrame(rows[::-1], "h bigint, l bigint").withColumn("k", S.packed(F.col("h"), F.col("l")))
    found = sorted((r.k, r.h, r.l) for r in df.collect())
    assert [r[1:] for r in found] == rows and len({r[0] for r in found}) == len(rows)
    li = S.table(spark, SF_SMALL, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    picked = li.withColumn("k", S.lineitem_order()).select("k", *order).collect()
    assert [r[1:] for r in sorted(picked)] == sorted(tuple(r[1:]) for r in picked)
