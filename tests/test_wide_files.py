"""Landed wide CSV files with a header of two rows; URL forms."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import local, write_files

from qtrbars.functions import payload as PL
from qtrbars.plans.pipelines import yahoo_quarterly_from_wide
from qtrbars.sources import wide as W

JAN, APR = dt.date(2024, 1, 1), dt.date(2024, 4, 1)


def _read(spark, folder):
    df = W.read_wide_csv(spark, folder)
    return df.columns, {(r.ticker, r.date): r.asDict() for r in df.collect()}


def test_headers_name_symbols_and_fields(spark, scratch):
    folder = write_files(f"{scratch}/w", {
        "a.csv": 'Ticker,AAA,AAA,"B,B","B,B"\nPrice,Open,Adj Close,Open,New Field\nDate,,,,\n'
                 "2024-01-01,1,2,3,4\n2024-04-01 00:00:00,5,,x,NaN\nnot a date,9,9,9,9\n\n",
        "b.csv": ",CCC\n,Open\n2024-01-01,7\n",  # blank first cells and no row that names the index
        "c.csv": "Ticker,DDD\n",  # no second row: no columns
    })
    columns, rows = _read(spark, folder)
    assert columns == ["ticker", "date", "open", "adj_close", "new_field", "_complete"]
    assert set(rows) == {("AAA", JAN), ("AAA", APR), ("B,B", JAN), ("B,B", APR), ("CCC", JAN)}
    assert (rows["AAA", JAN]["open"], rows["AAA", JAN]["adj_close"], rows["AAA", JAN]["_complete"]) == (1, 2, True)
    assert (rows["AAA", APR]["open"], rows["AAA", APR]["adj_close"], rows["AAA", APR]["_complete"]) == (5, None, False)
    assert rows["B,B", JAN]["new_field"] == 4 and rows["B,B", APR]["open"] is None and rows["B,B", APR]["new_field"] is None
    assert rows["CCC", JAN]["adj_close"] is None and rows["CCC", JAN]["_complete"]  # all that its file has


def test_newest_file_of_a_symbol_counts(spark, scratch):
    folder = write_files(f"{scratch}/w", {
        "new.csv": "Ticker,AAA,ZZZ\nPrice,Open,Open\n2024-01-01,10,1\n",
        "old.csv": "Ticker,AAA,BBB\nPrice,Open,Open\n2024-01-01,20,2\n2024-04-01,21,3\n"})
    for name, when in (("new.csv", 2_000_000_000), ("old.csv", 1_000_000_000)):
        os.utime(f"{local(folder)}/{name}", (when, when))
    _, rows = _read(spark, folder)
    assert {k: v["open"] for k, v in rows.items()} == {("AAA", JAN): 10, ("ZZZ", JAN): 1, ("BBB", JAN): 2, ("BBB", APR): 3}


def test_bars_from_two_row_headers(spark, scratch):
    fields = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
    head = "Ticker" + "".join(f",{t}" * 6 for t in ("AAA", "ZER")) + "\nPrice," + ",".join(fields * 2) + "\nDate" + "," * 12 + "\n"
    folder = write_files(f"{scratch}/w", {"batch.csv": head + "2024-01-01," + ",".join(["10,11,9,10,10,100"] * 2)
                                          + "\n2024-04-01,12,13,11,12,12,100,5,6,4,5,0,100\n"})
    bars, rejected = yahoo_quarterly_from_wide(spark, folder, fmt="csv2", data_load=dt.datetime(2024, 7, 1))
    got = {(r.ticker, r.quarter): r for r in bars.collect()}
    assert set(got) == {("AAA", "2024Q1"), ("AAA", "2024Q2")} and got["AAA", "2024Q2"].pct_change == 20.0
    assert [r.ticker for r in rejected.collect()] == ["ZER"]


def test_tens_of_thousands_of_columns(spark, scratch):
    n = 5_000
    head = "Ticker" + "".join(f",T{k}" * 6 for k in range(n)) + "\nPrice" + ",a,b,c,d,e,f" * n + "\n"
    folder = write_files(f"{scratch}/w", {"big.csv": head + "".join(
        f"20{y}-01-01" + ",1,2,3,4,5,6" * n + "\n" for y in range(10, 14))})
    began = time.time()
    found = W.read_wide_csv(spark, folder)
    assert found.agg(F.count("*"), F.sum("f"), F.sum(F.col("_complete").cast("int"))).first() == (4 * n, 24.0 * n, 4 * n)
    assert time.time() - began < 60


def test_no_files_with_columns(spark, scratch):
    folder = write_files(f"{scratch}/w", {"x.csv": "nothing here\n"})
    assert W.read_wide_csv(spark, folder).collect() == []


def test_url_forms(spark):
    values = ["a b", "x/y?z#1", "ü*~-._", "100%+", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    from urllib.parse import quote
    got = [r[0] for r in df.select(PL.path_segment("v")).collect()]
    assert got == [None if v is None else quote(v, safe="-._~") for v in values]
    row = df.limit(1).select(PL.template_url("https://h/repos/{owner}/{name}", owner=F.lit("o/o"), name=F.col("v")).alias("t"),
                             PL.joined_url(F.lit("https://h"), F.lit("api/random")).alias("j"),
                             PL.request_url(F.lit("h"), F.lit("/p"), F.lit(False)).alias("f"),
                             PL.request_url(F.lit("https://h"), F.lit("/p"), F.lit(True)).alias("s")).first()
    assert tuple(row) == ("https://h/repos/o%2Fo/a%20b", "https://h/api/random", "http://h/p", "https://h/p")
    with pytest.raises(ValueError):
        PL.template_url("https://h/{owner}", name=F.lit("x"))
