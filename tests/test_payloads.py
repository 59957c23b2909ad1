"""Payload classification and parsing on the hand-written fixtures."""

import datetime as dt
import os

from conftest import local, write_files

from qtrbars.plans import pipelines as P

AV_OK = """timestamp,open,high,low,close,adjusted_close,volume,dividend_amount,split_coefficient
2024-04-02,13.0,14.0,12.0,13.5,13.5,200,0.0,1.0
2024-04-01,12.0,13.0,11.0,12.5,12.5,100,0.25,2.0
2024-03-28,11.0,12.0,10.0,11.5,11.0,300,0.0,1.0
2024-01-02,10.0,11.0,9.0,10.5,10.0,100,0.1,1.0
"""
HEADER = AV_OK.splitlines()[0] + "\n"

AV_FILES = {
    "AAA.csv": AV_OK,
    "RATE.csv": '{"message":"You have exceeded the DAILY quota for this API key"}',
    "UNK.csv": '{\n    "Error Message": "Invalid API call. Please retry or visit the documentation."\n}\n',
    "HEAD.csv": HEADER,
    "NARROW.csv": "timestamp,open,high,low,close\n2024-01-02,1,2,0.5,1.5\n",
    "OTHER.csv": '{\n    "Note": "Thank you for using the service."\n}\n',
    "LATE.csv": '{\n    "Information": "' + "x" * 120 + ' exceeded the rate limit per minute"\n}\n',
    "BADDATE.csv": HEADER + "2024-13-45,1,2,0.5,1.5,1.5,10,0,1\n",
}

FMP_FILES = {
    "AAA.json": '{"symbol":"AAA","historical":['
                '{"date":"2024-04-02","open":13.0,"high":14.0,"low":12.0,"close":13.5,"adjClose":13.5,"volume":200},'
                '{"date":"2024-01-02","open":10.0,"high":11.0,"low":9.0,"close":10.5,"adjClose":10.0,"volume":100}]}',
    "EMPTY.json": "{}",
    "LIMIT.json": '{"Error Message":"Limit Reach . Please upgrade your plan"}',
    "NOHIST.json": '{"note":"x"}',
    "EMPTYHIST.json": '{"symbol":"EMPTYHIST","historical":[]}',
    "BIG.json": '{"symbol":"BIG","historical":[{"date":"2024-01-02","open":1.0,"high":1.0,"low":1.0,'
                '"close":1.0,"adjClose":1.0,"volume":99999999999999999999999}]}',
}

LOAD = dt.datetime(2024, 7, 1, 12, 0, 0)


def _status(out):
    return {r.ticker: r.status for r in out["classified"].collect()}


def test_av_classification(spark, scratch):
    land = write_files(os.path.join(scratch, "av"), AV_FILES)
    out = P.av_quarterly(spark, land, data_load=LOAD)
    assert _status(out) == {
        "AAA": "ok", "RATE": "rate_limited", "UNK": "not_available", "HEAD": "unrecognized",
        "NARROW": "unrecognized", "OTHER": "unrecognized", "LATE": "unrecognized",
        "BADDATE": "unparseable"}
    assert {r.ticker for r in out["not_available"].collect()} == {"UNK"}
    assert {r.ticker for r in out["retry"].collect()} == {"RATE"}
    q = {r.ticker: r.reason for r in out["quarantine"].collect()}
    assert q == {"HEAD": "unrecognized", "NARROW": "unrecognized", "OTHER": "unrecognized",
                 "LATE": "unrecognized", "BADDATE": "unparseable"}


def test_av_bars_values(spark, scratch):
    land = write_files(os.path.join(scratch, "av"), {"AAA.csv": AV_OK})
    bars = P.av_quarterly(spark, land, data_load=LOAD)["bars"]
    rows = {r.quarter: r for r in bars.collect()}
    q2, q1 = rows["2024Q2"], rows["2024Q1"]
    assert (q2.open, q2.high, q2.low, q2.close, q2.adjusted_close) == (12.0, 14.0, 11.0, 13.5, 13.5)
    assert (q2.volume, q2.dividend_amount, q2.split_coefficient) == (300, 0.25, 2.0)
    assert q2.date == dt.date(2024, 6, 30) and q2.pct_change == 22.73 and q2.compound_return == 22.73
    assert (q1.open, q1.high, q1.low, q1.close, q1.adjusted_close) == (10.0, 12.0, 9.0, 11.5, 11.0)
    assert (q1.volume, q1.dividend_amount, q1.split_coefficient) == (400, 0.1, 1.0)
    assert q1.date == dt.date(2024, 3, 31) and q1.pct_change is None and q1.compound_return == 0.0
    assert q1.source == "AV" and q1.data_load == LOAD


def test_fmp_classification_and_bars(spark, scratch):
    land = write_files(os.path.join(scratch, "fmp"), FMP_FILES)
    out = P.fmp_quarterly(spark, land, data_load=LOAD)
    assert _status(out) == {"AAA": "ok", "EMPTY": "not_available", "LIMIT": "rate_limited",
                            "NOHIST": "unrecognized", "EMPTYHIST": "unrecognized",
                            "BIG": "unparseable"}
    bars = {r.quarter: r for r in out["bars"].collect()}
    assert set(bars) == {"2024Q1", "2024Q2"}
    assert bars["2024Q2"].dividend_amount is None and bars["2024Q2"].split_coefficient is None
    assert bars["2024Q2"].pct_change == 35.0 and bars["2024Q1"].compound_return == 0.0


def test_newest_payload_wins(spark, scratch):
    land = os.path.join(scratch, "av2")
    write_files(land, {"AAA.csv": HEADER})
    old = os.path.join(local(land), "AAA.csv")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    write_files(land, {"AAA_AV_2.csv": AV_OK})
    out = P.av_quarterly(spark, land, data_load=LOAD)
    assert _status(out) == {"AAA": "ok"}
    assert out["bars"].count() == 2


AV_3Q = AV_OK + "2024-07-01,14.0,15.0,13.0,14.5,14.3,50,0.0,1.0\n"


def test_compound_base_is_first_quarter_close(spark, scratch):
    # base = last adjusted close of the first quarter (11.0), not of its first day (10.0)
    land = write_files(f"{scratch}/av3", {"AAA.csv": AV_3Q})
    bars = {r.quarter: r for r in P.av_quarterly(spark, land, data_load=LOAD)["bars"].collect()}
    assert bars["2024Q3"].compound_return == 30.0          # (14.3 - 11.0) / 11.0
    assert bars["2024Q3"].pct_change == 5.93               # (14.3 - 13.5) / 13.5
    assert bars["2024Q2"].compound_return == bars["2024Q2"].pct_change == 22.73


def test_product_path_uses_hash_aggregate(spark):
    df = spark.createDataFrame([("AV", "AAA", None, None, AV_OK)],
                               "source string, ticker string, path string, modified timestamp, payload string")
    bars = P.process_payloads(df, "AV")["bars"]
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_repeated_date_is_deterministic(spark, scratch):
    # the vendor repeats 2024-04-02; the row listed first in the payload is
    # the earlier one, so it is the quarter's open
    dup = HEADER + ("2024-04-02,20.0,21.0,19.0,20.5,20.5,10,0.0,1.0\n"
                    "2024-04-02,30.0,31.0,29.0,30.5,30.5,10,0.0,1.0\n")
    land = write_files(f"{scratch}/dup", {"DUP.csv": dup})
    for _ in range(2):
        r = P.av_quarterly(spark, land, data_load=LOAD)["bars"].collect()[0]
        assert (r.open, r.close) == (20.0, 30.5)
