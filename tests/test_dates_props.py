"""Quarter rules checked against pandas' period and offset arithmetic on
random dates, and the ratio percent change against pandas' pct_change."""

import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qtrbars.functions import dates as D
from qtrbars.operators.returns import with_pct_change

DATES = st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                 min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(DATES)
def test_quarter_functions_match_pandas(spark, days):
    edge = [dt.date(2024, 3, 31), dt.date(2024, 6, 30), dt.date(2024, 9, 30), dt.date(2024, 12, 31),
            dt.date(2024, 1, 1), dt.date(2000, 2, 29)]
    days = days + edge
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r for r in df.select(
        "d", D.quarter_label("d").alias("label"), D.quarter_end("d").alias("qend"),
        D.quarter_end_offset("d").alias("off"), D.quarter_start("d").alias("qs")).collect()}
    for d in days:
        ts = pd.Timestamp(d)
        r = got[d]
        assert r.label == str(ts.to_period("Q"))
        assert r.qend == ts.to_period("Q").end_time.date()
        assert r.qs == ts.to_period("Q").start_time.date()
        assert r.off == (ts + pd.offsets.QuarterEnd()).date()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0.5, max_value=1000, allow_nan=False), min_size=2, max_size=30))
def test_ratio_pct_change_matches_pandas(spark, prices):
    rows = [("T", i, p) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "ticker string, i int, adjusted_close double")
    got = [r.pct_change for r in with_pct_change(df, "ticker", "i", method="ratio")
           .orderBy("i").collect()]
    s = pd.Series(prices[::-1])  # newest first, as the vendor frame is sorted
    want = list(((s.pct_change(-1) * 100).round(2))[::-1])
    for g, w in zip(got, want):
        if pd.isna(w):
            assert g is None
        else:
            assert abs(g - w) <= 0.0100001  # half-up vs half-even on exact ties


def test_parse_day_rejects_bad_text(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-13-01",), ("x",), (None,)], "s string")
    got = [r.d for r in df.select(D.parse_day("s").alias("d")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None]
