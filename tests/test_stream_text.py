"""Incremental ingest from a landing folder of one text file per payload."""

import datetime as dt

from conftest import write_files
from test_payloads import AV_OK, HEADER

from qtrbars.sinks import parquet as SK
from qtrbars.streaming import ingest as ING


def test_text_landing_two_rounds(spark, scratch):
    land = f"{scratch}/land"
    bars, reg, quar, ckpt = (f"{scratch}/{n}" for n in ("bars", "na", "q", "ckpt"))
    write_files(land, {"AAA.csv": AV_OK, "UNK.csv": '{\n "Error Message": "Invalid API call x"\n}\n'})
    ING.run_ingest(spark, land, "AV", bars, reg, quar, ckpt, fmt="text",
                   data_load=dt.datetime(2024, 7, 1))
    got = {r.quarter: r.close for r in SK.read_bucketed(spark, bars).collect()}
    assert got == {"2024Q1": 11.5, "2024Q2": 13.5}
    assert [r.ticker for r in SK.read_bucketed(spark, reg, SK.RECORD_SCHEMA).collect()] == ["UNK"]
    # second round: a corrected AAA payload (one quarter only) replaces AAA
    write_files(land, {"AAA_AV_2.csv": HEADER + "2024-05-02,1,2,0.5,1.5,1.5,10,0,1\n"})
    ING.run_ingest(spark, land, "AV", bars, reg, quar, ckpt, fmt="text",
                   data_load=dt.datetime(2024, 7, 2))
    got = {r.quarter: r.close for r in SK.read_bucketed(spark, bars).collect()}
    assert got == {"2024Q2": 1.5}
