"""Ordered tables: positions, resuming, ranges."""

import random

import pytest
from pyspark.sql import functions as F

from qtrbars.sinks import ordered as OT


def _rows(n=3000):
    r = random.Random(6)
    return [(r.choice(["HOT"] * 5 + [f"T{r.randrange(400):03d}", None]), k, r.random()) for k in range(n)]


@pytest.fixture()
def table(spark, scratch):
    rows = _rows()
    OT.write_ordered(spark.createDataFrame(rows, "ticker string, position_id bigint, x double").repartition(5),
                     f"{scratch}/t", ["ticker"], files=12)
    return f"{scratch}/t", rows


def test_positions_follow_the_order(spark, table):
    path, rows = table
    found = sorted(OT.read_ordered(spark, path).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(len(rows)))
    assert [r.ticker for r in found] == sorted((t for t, _, _ in rows), key=lambda t: (t is not None, t or ""))
    assert sorted(r.position_id for r in found) == list(range(len(rows)))
    files = OT.ordered_files(spark, path).orderBy("start").collect()
    assert max(f.rows for f in files) < len(rows) / 4  # the frequent symbol is spread
    assert [f.start for f in files] == [sum(g.rows for g in files[:k]) for k in range(len(files))]


def test_resuming_opens_only_later_files(spark, table):
    path, rows = table
    whole = {r.position: r for r in OT.read_ordered(spark, path).collect()}
    rest = OT.read_ordered(spark, path, skip=2000)
    assert len(rest.inputFiles()) - 1 < len(OT.read_ordered(spark, path).inputFiles()) - 3
    assert {r.position: r for r in rest.collect()} == {p: r for p, r in whole.items() if p >= 2000}
    assert OT.read_ordered(spark, path, skip=len(rows)).collect() == []
    assert OT.read_ordered(spark, path, skip=len(rows)).columns == ["ticker", "position_id", "x", "position"]


def test_range_of_symbols(spark, table):
    path, rows = table
    part = OT.read_ordered(spark, path, key="ticker", least="T100", greatest="T199")
    assert len(part.inputFiles()) < len(OT.read_ordered(spark, path).inputFiles())
    assert sorted(r.ticker for r in part.collect()) == sorted(t for t, _, _ in rows if t and "T100" <= t <= "T199")


def test_empty_and_unfinished(spark, scratch):
    OT.write_ordered(spark.createDataFrame([], "ticker string"), f"{scratch}/e", ["ticker"])
    assert OT.read_ordered(spark, f"{scratch}/e").count() == 0
    spark.range(3).select(F.col("id").cast("string").alias("ticker")).write.parquet(f"{scratch}/u/rows")
    with pytest.raises(FileNotFoundError):
        OT.read_ordered(spark, f"{scratch}/u")
