"""Replace-by-ticker sinks and the incremental stream."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL

from qtrbars.plans import pipelines as P
from qtrbars.plans import standins as S
from qtrbars.sinks import parquet as SK
from qtrbars.streaming import ingest as ING

LOAD = "2024-01-01 00:00:00"


def _bars(spark, where=None):
    orders = S.table(spark, SF_SMALL, "orders")
    if where is not None:
        orders = orders.where(where)
    daily = S.daily_from_orders(orders)
    return P.daily_to_quarterly(daily, "FMP", actions=False, order=F.col("_order"), data_load=LOAD)


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_replace_by_ticker_layouts(spark, scratch):
    for layout in ("ticker", "bucket"):
        path = f"{scratch}/{layout}"
        write = SK.replace_by_ticker if layout == "ticker" else SK.replace_in_buckets
        read = SK.read_table if layout == "ticker" else SK.read_bucketed
        full = _bars(spark)
        write(full, path)
        before = _rows(read(spark, path))
        write(full, path)  # running twice changes nothing
        assert _rows(read(spark, path)) == before
        # replace C1 with a one-quarter restatement; everything else stays
        others_before = _rows(read(spark, path).where(F.col("ticker") != "C1"))
        c1 = full.where(F.col("ticker") == "C1").limit(1).withColumn("close", F.lit(-1.0))
        write(c1, path)
        after = read(spark, path)
        assert [r.close for r in after.where(F.col("ticker") == "C1").collect()] == [-1.0]
        assert _rows(after.where(F.col("ticker") != "C1")) == others_before


def test_stream_equals_batch(spark, scratch):
    rows = S.order_landing_rows(S.table(spark, SF_SMALL, "orders"))
    landing, bars = f"{scratch}/landing", f"{scratch}/bars"
    reg, quar, ckpt = f"{scratch}/na", f"{scratch}/q", f"{scratch}/ckpt"
    cut = F.lit("1998-01-01").cast("timestamp")
    ING.land(rows.where(F.col("fetched_at") < cut), landing)
    ING.run_ingest(spark, landing, "AV", bars, reg, quar, ckpt, data_load=LOAD)
    ING.land(rows.where(F.col("fetched_at") >= cut), landing)
    ING.run_ingest(spark, landing, "AV", bars, reg, quar, ckpt, data_load=LOAD)
    streamed = _rows(SK.read_bucketed(spark, bars))
    q = ING.run_ingest(spark, landing, "AV", bars, reg, quar, ckpt, data_load=LOAD)
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert _rows(SK.read_bucketed(spark, bars)) == streamed
    # one batch over everything landed
    batch_in = (spark.read.schema(ING.LANDING_SCHEMA).parquet(landing)
                .select(F.lit("AV").alias("source"), "ticker", F.lit(None).cast("string").alias("path"),
                        F.col("fetched_at").alias("modified"), "fetch_id", "payload"))
    from qtrbars.sources.payloads import newest_per_ticker
    out = P.process_payloads(newest_per_ticker(batch_in, ("modified", "fetch_id", "path")), "AV",
                             dt.datetime(2024, 1, 1))
    assert _rows(out["bars"]) == streamed


def test_publish_manifest_and_pending(spark, scratch):
    from conftest import write_files
    from test_payloads import AV_FILES
    land = write_files(f"{scratch}/land", AV_FILES)
    out = P.av_quarterly(spark, land, data_load=dt.datetime(2024, 7, 1))
    bars, reg, quar, man = (f"{scratch}/{n}" for n in ("bars", "na", "q", "manifest"))
    P.publish(out, bars, reg, quar, manifest_path=man)
    m = SK.read_bucketed(spark, man, SK.MANIFEST_SCHEMA).collect()
    assert [(r.ticker, r.first_quarter, r.last_quarter) for r in m] == [("AAA", "2024Q1", "2024Q2")]
    assert [r.ticker for r in SK.read_bucketed(spark, reg, SK.RECORD_SCHEMA).collect()] == ["UNK"]
    universe = spark.createDataFrame([(t,) for t in ("AAA", "UNK", "RATE", "NEW", "NEW")], "ticker string")
    pending = sorted(r.ticker for r in P.pending_work(spark, universe, bars, "AV").collect())
    assert pending == ["NEW", "RATE"]
