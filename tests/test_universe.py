"""Ticker universe on the hand-written security tables."""

from collections import Counter

from pyspark.sql import functions as F

from qtrbars.operators import universe as U

MAP = [("001", "AAA"), ("001", "AAA"), ("002", "BRKB"), ("003", "BRKA"), ("004", "A1B"),
       ("005", "9ZZ"), ("006", "X/Y"), ("007", "P*"), ("008", "AAA"), ("009", "NOP"), ("010", None)]
PRICES = ["001", "002", "003", "004", "005", "006", "007", "008", "010", "001", "004"]


def _tables(spark):
    m = spark.createDataFrame(MAP, "cusip string, ticker string")
    p = spark.createDataFrame([(c,) for c in PRICES], "cusip string")
    return p, m


def test_universe_strict(spark):
    p, m = _tables(spark)
    got = [r.ticker for r in U.normalize_tickers(U.ticker_universe(p, m)).collect()]
    assert Counter(got) == Counter(["AAA", "AAA", "BRK-A", "BRK-B"])


def test_universe_leading(spark):
    p, m = _tables(spark)
    got = [r.ticker for r in U.normalize_tickers(U.ticker_universe(p, m), digits="leading").collect()]
    assert Counter(got) == Counter(["AAA", "AAA", "BRK-A", "BRK-B", "A1B"])


def test_round_robin_and_offset(spark):
    df = spark.range(0, 1000).select(F.format_string("T%04d", "id").alias("ticker"))
    b = U.round_robin_batches(df, 7, ["ticker"])
    sizes = [r["count"] for r in b.groupBy("batch").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    by_t = {r.ticker: r.batch for r in b.collect()}
    assert by_t["T0000"] == 0 and by_t["T0008"] == 1 and by_t["T0999"] == 999 % 7
    rest = [r.ticker for r in U.skip_first(df, 990, ["ticker"]).collect()]
    assert sorted(rest) == [f"T{i:04d}" for i in range(990, 1000)]


def test_sample_is_repeatable(spark):
    df = spark.range(0, 500).select(F.format_string("T%03d", "id").alias("ticker"))
    a = [r.ticker for r in U.sample_tickers(df, 30, seed=7).collect()]
    b = [r.ticker for r in U.sample_tickers(df.repartition(5), 30, seed=7).collect()]
    assert a == b and len(set(a)) == 30


def test_pending_is_disjoint_from_done(spark):
    uni = spark.createDataFrame([("A",), ("B",), ("C",), ("C",)], "ticker string")
    done = spark.createDataFrame([("B",), ("Z",)], "ticker string")
    assert sorted(r.ticker for r in U.pending_tickers(uni, done).collect()) == ["A", "C"]


def test_universe_from_files(spark, scratch):
    from qtrbars.plans.pipelines import universe
    p, m = _tables(spark)
    p.withColumn("median_price", F.lit(1.0)).write.parquet(f"{scratch}/prices")
    m.write.parquet(f"{scratch}/map")
    got = [r.ticker for r in universe(spark, f"{scratch}/prices", f"{scratch}/map").collect()]
    assert Counter(got) == Counter(["AAA", "AAA", "BRK-A", "BRK-B"])


