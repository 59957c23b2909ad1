"""Invariants of the quarterly bars on the driver tables, and order independence."""

from pyspark.sql import functions as F

from conftest import SF_SMALL

from qtrbars.plans import pipelines as P
from qtrbars.plans import standins as S


def _bars(spark, daily):
    return P.daily_to_quarterly(daily, "AV", order=F.col("_order"), data_load="2024-01-01 00:00:00")


def test_bar_invariants(spark):
    daily = S.daily_from_lineitem(S.table(spark, SF_SMALL, "lineitem"))
    bars = _bars(spark, daily).cache()
    assert bars.where(~((F.col("low") <= F.col("open")) & (F.col("open") <= F.col("high"))
                        & (F.col("low") <= F.col("close")) & (F.col("close") <= F.col("high")))).count() == 0
    assert bars.groupBy("source", "ticker", "quarter").count().where("count > 1").count() == 0
    first = (bars.groupBy("ticker").agg(F.min("quarter").alias("quarter"))
                 .join(bars, ["ticker", "quarter"]))
    assert first.where((F.col("compound_return") != 0) | F.col("pct_change").isNotNull()).count() == 0
    assert (bars.agg(F.sum("volume")).first()[0] == daily.agg(F.sum("volume")).first()[0])
    bars.unpersist()


def test_order_independence(spark):
    daily = S.daily_from_lineitem(S.table(spark, SF_SMALL, "lineitem"))
    a = _bars(spark, daily).drop("data_load")
    b = _bars(spark, daily.repartition(13, F.rand(3)).sortWithinPartitions(F.rand(5))).drop("data_load")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
