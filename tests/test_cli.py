"""The command line runs the folder pipelines end to end."""

from conftest import write_files
from test_payloads import AV_FILES

from qtrbars.__main__ import main
from qtrbars.sinks import parquet as SK


def test_cli_av_and_universe(spark, scratch):
    land = write_files(f"{scratch}/av", AV_FILES)
    lake = f"{scratch}/lake"
    assert main(["av", "--landing", land, "--lake", lake], spark=spark) == 0
    bars = SK.read_bucketed(spark, f"{lake}/bars")
    assert sorted(r.quarter for r in bars.collect()) == ["2024Q1", "2024Q2"]
    na = SK.read_bucketed(spark, f"{lake}/not_available", SK.RECORD_SCHEMA)
    assert [r.ticker for r in na.collect()] == ["UNK"]
    man = SK.read_bucketed(spark, f"{lake}/manifest", SK.MANIFEST_SCHEMA).collect()
    assert [(r.first_quarter, r.last_quarter) for r in man] == [("2024Q1", "2024Q2")]

    p = spark.createDataFrame([("001",), ("002",)], "cusip string")
    m = spark.createDataFrame([("001", "AAA"), ("002", "BRKB")], "cusip string, ticker string")
    p.write.parquet(f"{scratch}/prices")
    m.write.parquet(f"{scratch}/map")
    assert main(["universe", "--prices", f"{scratch}/prices", "--mapping", f"{scratch}/map",
                 "--out", f"{scratch}/universe"], spark=spark) == 0
    got = sorted(r.ticker for r in spark.read.parquet(f"{scratch}/universe").collect())
    assert got == ["AAA", "BRK-B"]


def test_cli_fmp_and_yahoo(spark, scratch):
    from test_payloads import FMP_FILES
    land = write_files(f"{scratch}/fmp", FMP_FILES)
    lake = f"{scratch}/lake"
    assert main(["fmp", "--landing", land, "--lake", lake], spark=spark) == 0
    bars = SK.read_bucketed(spark, f"{lake}/bars").collect()
    assert {(r.source, r.ticker) for r in bars} == {("FMP", "AAA")}
    q = SK.read_bucketed(spark, f"{lake}/quarantine", SK.RECORD_SCHEMA).collect()
    assert sorted(r.ticker for r in q) == ["BIG", "EMPTYHIST", "NOHIST"]

    header = "Date,AAA|Open,AAA|High,AAA|Low,AAA|Close,AAA|Adj Close,AAA|Volume"
    wide = write_files(f"{scratch}/yahoo", {"b.csv": header + "\n2024-01-01,1,2,0.5,1.5,1.5,10\n"
                                                      "2024-04-01,2,3,1.5,2.5,2.5,20\n"})
    assert main(["yahoo", "--landing", wide, "--lake", lake, "--format", "csv"], spark=spark) == 0
    ybars = [r for r in SK.read_bucketed(spark, f"{lake}/bars").collect() if r.source == "YAHOO"]
    assert sorted(r.quarter for r in ybars) == ["2024Q1", "2024Q2"]
    # the FMP bars in the same lake are untouched by the Yahoo publish
    assert {(r.source, r.ticker) for r in SK.read_bucketed(spark, f"{lake}/bars").collect()
            if r.source == "FMP"} == {("FMP", "AAA")}


def test_cli_pending_and_vacuum(spark, scratch):
    land = write_files(f"{scratch}/av", AV_FILES)
    lake = f"{scratch}/lake"
    for _ in range(3):  # three versions of every table
        assert main(["av", "--landing", land, "--lake", lake], spark=spark) == 0
    spark.createDataFrame([(t,) for t in ("AAA", "UNK", "RATE", "NEW", "HEAD", "ZED")], "ticker string").write.parquet(f"{scratch}/u")
    assert main(["pending", "--universe", f"{scratch}/u", "--lake", lake, "--source", "AV", "--out", f"{scratch}/work",
                 "--skip", "1", "--batches", "2"], spark=spark) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/work/batches").select("ticker", "position", "batch").collect())
    assert got == [("NEW", 1, 1), ("RATE", 2, 0), ("ZED", 3, 1)]  # HEAD is skipped
    before = sorted(r.quarter for r in SK.read_bucketed(spark, f"{lake}/bars").collect())
    assert len(SK.versions(spark, f"{lake}/bars")) == 3
    assert main(["vacuum", "--lake", lake, "--keep", "1"], spark=spark) == 0
    assert len(SK.versions(spark, f"{lake}/bars")) == 1
    assert sorted(r.quarter for r in SK.read_bucketed(spark, f"{lake}/bars").collect()) == before
    assert [r.ticker for r in SK.read_bucketed(spark, f"{lake}/not_available", SK.RECORD_SCHEMA).collect()] == ["UNK"]


def test_cli_wide_files(spark, scratch):
    head = "Ticker" + ",AAA" * 6 + "\nPrice,Open,High,Low,Close,Adj Close,Volume\n"
    wide = write_files(f"{scratch}/w", {"b.csv": head + "2024-01-01,1,2,0.5,1.5,1.5,10\n2024-04-01,2,3,1.5,2.5,2.5,20\n"})
    assert main(["yahoo", "--landing", wide, "--lake", f"{scratch}/lake", "--format", "csv2"], spark=spark) == 0
    bars = SK.read_bucketed(spark, f"{scratch}/lake/bars").collect()
    assert sorted((r.quarter, r.volume) for r in bars) == [("2024Q1", 10), ("2024Q2", 20)]
