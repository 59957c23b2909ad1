"""Incremental pick-up of newly landed payloads (Structured Streaming).

The landing folder receives payloads as they are fetched: either one text
file per payload (``fmt='text'``) or parquet files of payload rows
``(ticker, fetched_at, payload)`` written by the fetcher (``fmt='parquet'``,
the better layout at scale: few large files instead of millions of tiny ones).

Each micro-batch is handled by ``foreachBatch``: payloads of a ticker are full
histories, so for every ticker whose newest answer in the batch is new and has
another text than the stored one, all quarters are recomputed from it and its
buckets are replaced. Late or corrected payloads simply replace the ticker
again in a later batch; no state store is needed. The file source checkpoint
(in the shared folder) records which files were consumed, so a restarted or
re-run job picks up only new files, and a batch that failed (lost executor)
is replayed from the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import payload as PL
from ..plans.pipelines import index_path, payload_digest, process_payloads, publish
from ..sinks import parquet as SK
from ..sources.payloads import payload_frame

#: Up to so many wanted fetches (a few hundred bytes each) are sent to every executor, or hashed by a task.
BROADCAST_FETCHES, HASHED_FETCHES = 20_000, 500_000

LANDING_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("fetch_id", T.LongType()),
    T.StructField("payload", T.StringType()),
])


def land(payloads: DataFrame, landing: str) -> None:
    """Append fetched payload rows (ticker, fetched_at, fetch_id, payload) to
    the landing folder as new parquet files."""
    payloads.select(*[f.name for f in LANDING_SCHEMA.fields]).write.mode("append").parquet(landing)


def landing_stream(spark: SparkSession, landing: str, vendor: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of payload rows (source, ticker, path, modified, payload)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        raw = reader.text(landing, wholetext=True)
        return payload_frame(raw, vendor, latest_only=False).withColumn(
            "fetch_id", F.lit(None).cast("bigint"))
    if fmt == "parquet":
        raw = reader.schema(LANDING_SCHEMA).parquet(landing)
        return raw.select(F.lit(vendor).alias("source"), "ticker",
                          F.col("_metadata.file_path").alias("path"),
                          F.col("fetched_at").alias("modified"), "fetch_id", "payload")
    raise ValueError("fmt must be 'text' or 'parquet'")


def decide(batch: DataFrame, vendor: str, index: DataFrame) -> DataFrame:
    """The newest payload of each ticker in a batch, held against the key index.

    (source, ticker, modified, fetch_id, path, digest, state, changed, newer): ``changed``
    payloads have to be processed; of the others, ``newer`` ones are refetches
    of the text already stored, and the rest is older or the same fetch again.
    Text leaves this step as its SHA-256 only.
    """
    def when(*values):
        return F.struct(*[v.alias(n) for v, n in zip(values, ("m", "f", "p"))])

    def order(fetch: str, path: str):  # a path tells fetches apart where there is no fetch id
        return F.coalesce(fetch, F.lit(-1)), F.when(F.col(fetch).isNull(), F.coalesce(path, F.lit(""))).otherwise("")

    # heads are sorted by ticker before they are reduced: nothing stands in them twice, and the ticker
    # leads the key, as Spark compares the first bytes of the first column fastest (the source is the same in all)
    fetch, place = order("fetch_id", "path")
    heads = batch.select("ticker", "source", F.struct(
        PL.is_answer("payload", vendor).alias("answer"), F.col("modified").alias("m"), fetch.alias("f"), place.alias("p"),
        F.col("fetch_id").isNotNull().alias("has_id"), "path", payload_digest("payload").alias("digest")).alias("head"))
    newest = heads.groupBy("ticker", "source").agg(F.max("head").alias("head")).select(
        "ticker", "source", "head.answer", when(F.col("head.m"), F.col("head.f"), F.col("head.p")).alias("when"),
        F.col("head.m").alias("modified"), F.when(F.col("head.has_id"), F.col("head.f")).alias("fetch_id"), "head.path", "head.digest")
    stored = index.select("ticker", "source", "state", when(F.col("modified"), *order("fetch_id", "path")).alias("last"),
                          F.col("digest").alias("last_digest"))
    both = newest.join(stored, ["ticker", "source"], "left")
    same = F.col("digest").eqNullSafe(F.col("last_digest"))
    return both.select(
        "source", "ticker", "modified", "fetch_id", "path", "digest", "state",
        (F.col("last").isNull() | ((F.col("when") >= F.col("last")) & ~same)).alias("changed"),
        F.coalesce(F.col("answer") & same & (F.col("when") > F.col("last")), F.lit(False)).alias("newer"))


def wanted_payloads(batch: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a batch that ``wanted`` (of ``decide``) names, one for each ticker.

    Nothing of the batch is read if none is wanted. Few wanted rows go to the payloads; else both
    sides are dealt by fetch and the wanted rows of a task are hashed (while they
    number few enough), so no payload is sorted. Texts are hashed after the
    join, those of the fetches found only.
    """
    n = wanted.count()
    if not n:
        return batch.where(F.lit(False))
    fetch = ("ticker", "source", "modified", "fetch_id", "path")
    keys = wanted.select(*[F.col(c).alias(f"_{c}") for c in (*fetch, "digest")])
    tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= BROADCAST_FETCHES:
        keys = keys.hint("broadcast")
    elif n <= HASHED_FETCHES * tasks:
        keys = keys.hint("shuffle_hash")
    same = F.lit(True)
    for c in fetch:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = PL.stage(batch.join(keys, same), "_text", payload_digest("payload")).where("_text = _digest")
    # a fetch that was landed twice is one; this also deals payloads to all tasks for parsing
    return found.select(*batch.columns).dropDuplicates(["ticker", "source"])


def process_batch(batch: DataFrame, vendor: str, bars_path: str, registry_path: str,
                  quarantine_path: str, data_load=None, layout: str = "bucket",
                  manifest_path: str | None = None) -> None:
    """One micro-batch: newest answer per ticker -> replace its outputs.

    Which answer was fetched last, and the digest of its text, stand in the key
    index beside the bars (rate-limit messages are no answers and leave no
    trace there). A payload older than the one already processed is dropped,
    so the result doesn't depend on the order of arrival; one whose text is
    the stored one isn't parsed, and touches no table but the index (and not
    that, if it is the same fetch again). The index is written last, so a batch
    that failed is processed again when it is replayed.
    """
    spark = batch.sparkSession
    index = SK.read_bucketed(spark, index_path(bars_path), SK.INDEX_SCHEMA, source=vendor)
    decided = decide(batch, vendor, index).persist()
    try:
        payloads = wanted_payloads(batch, decided.where("changed"))
        out = process_payloads(payloads, vendor, data_load, cache=True)
        refreshed = decided.where("newer").select("source", "ticker", "state", "modified", "fetch_id", "path", "digest")
        try:
            publish(out, bars_path, registry_path, quarantine_path, layout=layout, manifest_path=manifest_path, refreshed=refreshed)
        finally:
            out["classified_frame"].unpersist()
    finally:
        decided.unpersist()


def run_ingest(spark: SparkSession, landing: str, vendor: str, bars_path: str,
               registry_path: str, quarantine_path: str, checkpoint: str,
               fmt: str = "parquet", data_load=None, timeout_s: float | None = None,
               layout: str = "bucket", manifest_path: str | None = None):
    """Process everything landed since the last run, then stop
    (``trigger(availableNow=True)``: a batch job with stream bookkeeping)."""
    stream = landing_stream(spark, landing, vendor, fmt)
    query = (stream.writeStream
             .foreachBatch(lambda df, _epoch: process_batch(
                 df, vendor, bars_path, registry_path, quarantine_path, data_load, layout, manifest_path))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    # returns None without a timeout, else whether it ended in time
    if timeout_s is not None and not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"ingest did not finish within {timeout_s} s; the stored tables are incomplete")
    if timeout_s is None:
        query.awaitTermination()
    return query
