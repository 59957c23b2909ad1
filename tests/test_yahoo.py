"""Wide 3-month vendor table -> cleaned quarterly bars (FIXTURES 1.6)."""

import datetime as dt

from pyspark.sql import types as T

from qtrbars.operators.reshape import wide_to_long
from qtrbars.plans.pipelines import yahoo_quarterly

FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits"]


def _wide(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 3, 31), dt.date(2024, 4, 1)
    full = lambda v: [v, v + 1, v - 1, v, v, 100.0, 0.5, 0.0]
    none = [None] * 8
    cols = {
        "AAA": ({d1: full(10.0), d2: none, d3: full(12.0)}, FIELDS + ["Capital Gains"]),
        "NUL": ({d1: [None] + full(5.0)[1:], d2: none, d3: full(6.0)}, FIELDS),
        "NEG": ({d1: full(5.0)[:4] + [0.0] + full(5.0)[5:], d2: none, d3: full(6.0)}, FIELDS),
        "ALLNUL": ({d1: none, d2: none, d3: none}, FIELDS),
        "EDGE": ({d1: none, d2: full(7.0), d3: none}, FIELDS),
        "NODIV": ({d1: full(3.0)[:6], d2: [None] * 6, d3: [None] * 6}, FIELDS[:6]),
    }
    names, fields = ["Date"], [T.StructField("Date", T.DateType())]
    for t, (_, fl) in cols.items():
        for f in fl:
            names.append(f"{t}|{f}")
            fields.append(T.StructField(f"{t}|{f}", T.DoubleType()))
    rows = []
    for d in (d1, d2, d3):
        row = [d]
        for t, (vals, fl) in cols.items():
            v = list(vals[d]) + [0.0 if vals[d][0] is not None else None] * (len(fl) - len(vals[d]))
            row += v[:len(fl)]
        rows.append(row)
    return spark.createDataFrame(rows, T.StructType(fields))


def test_yahoo_fixture(spark):
    long = wide_to_long(_wide(spark), index="Date")
    bars, rejected = yahoo_quarterly(long, data_load=dt.datetime(2024, 7, 1))
    got = {(r.ticker, r.quarter): r for r in bars.collect()}
    assert set(got) == {("AAA", "2024Q1"), ("AAA", "2024Q2"), ("NUL", "2024Q2"),
                        ("EDGE", "2024Q1"), ("NODIV", "2024Q1")}
    assert got[("AAA", "2024Q1")].date == dt.date(2024, 3, 31)
    assert got[("AAA", "2024Q2")].date == dt.date(2024, 6, 30)
    assert got[("AAA", "2024Q2")].pct_change == 20.0
    assert got[("AAA", "2024Q2")].compound_return == 20.0
    assert got[("AAA", "2024Q1")].pct_change is None
    assert got[("EDGE", "2024Q1")].date == dt.date(2024, 6, 30)
    nd = got[("NODIV", "2024Q1")]
    assert nd.dividend_amount == 0.0 and nd.split_coefficient == 0.0 and nd.volume == 100
    assert [r.ticker for r in rejected.collect()] == ["NEG"]


def test_yahoo_from_landed_wide_csv(spark, scratch):
    from conftest import write_files
    from qtrbars.plans.pipelines import yahoo_quarterly_from_wide
    header = "Date," + ",".join(f"{t}|{f}" for t in ("AAA", "ZER") for f in FIELDS[:6])
    lines = [header,
             "2024-01-01," + ",".join(["10,11,9,10,10,100"] * 2),
             "2024-04-01,12,13,11,12,12,100,5,6,4,5,0,100"]
    land = write_files(f"{scratch}/wide", {"batch1.csv": "\n".join(lines) + "\n"})
    bars, rejected = yahoo_quarterly_from_wide(spark, land, fmt="csv", data_load=dt.datetime(2024, 7, 1))
    got = {(r.ticker, r.quarter): r for r in bars.collect()}
    assert set(got) == {("AAA", "2024Q1"), ("AAA", "2024Q2")}
    assert got[("AAA", "2024Q2")].pct_change == 20.0 and got[("AAA", "2024Q2")].volume == 100
    assert got[("AAA", "2024Q1")].dividend_amount == 0.0
    assert [r.ticker for r in rejected.collect()] == ["ZER"]
