"""Landed vendor payloads: one file per ticker and fetch, read whole.

A payload file is one vendor response body (bounded by what the vendor
returns for one symbol), so it is read as one row (``wholetext``); the many
files of a landing folder spread over tasks. Ticker and landing time come
from the file's metadata, not from its content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payload as PL


def read_payloads(spark: SparkSession, path: str, source: str, glob: str | None = None,
                  latest_only: bool = True) -> DataFrame:
    """(source, ticker, path, modified, payload) per landed file."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path, wholetext=True)
    return payload_frame(raw, source, latest_only)


def payload_frame(raw: DataFrame, source: str, latest_only: bool = True) -> DataFrame:
    """Turn a text-source frame (batch or stream) into payload rows."""
    df = raw.select(
        F.lit(source).alias("source"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("payload"))
    df = df.withColumn("ticker", ticker_of_file("path", source))
    return newest_per_ticker(df, vendor=source) if latest_only else df


def ticker_of_file(path: str, source: str) -> Column:
    """The ticker in a landed file's path, which is URL-encoded: '^GSPC' arrives
    as '%5EGSPC' ('+' stands for itself)."""
    decoded = F.try_url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return PL.ticker_from_path(F.coalesce(decoded, F.col(path)), source)


def newest_per_ticker(df: DataFrame, order=("modified", "path"), vendor: str | None = None) -> DataFrame:
    """Keep the newest payload of each ticker.

    With ``vendor``, the newest of its answers: a rate-limit message is kept
    only where a ticker has no other payload (it then stays pending).

    ``order`` must identify a fetch within a ticker (landing time then path
    for one file per payload; fetch time then fetch id for landed rows). The
    newest key per ticker is found on those metadata columns (and, with
    ``vendor``, the head of the payload) by a small
    partial aggregate, one row per ticker, then payloads are kept by a semi
    join on it; Spark chooses a broadcast or a shuffle from its measured size
    when it runs. The key comparison is null-safe (a text landing has no fetch id).
    """
    answer = [] if vendor is None else [PL.is_answer("payload", vendor).alias("_answer")]
    keyed = df.withColumn("_k", F.struct(*answer, *order))
    newest = (keyed.groupBy("source", "ticker").agg(F.max("_k").alias("_nk"))
                   .withColumnsRenamed({"source": "_ns", "ticker": "_nt"}))

    # distinct names on each side: no self-join ambiguity
    same = ((F.col("source") == F.col("_ns")) & (F.col("ticker") == F.col("_nt"))
            & F.col("_k").eqNullSafe(F.col("_nk")))
    return keyed.join(newest, same, "left_semi").drop("_k")


def classify(payloads: DataFrame, vendor: str) -> DataFrame:
    """Add ``rows`` (typed daily rows, array) and ``status``."""
    if vendor == "AV":
        return PL.with_av_parse(payloads, "payload")
    if vendor == "FMP":
        df = PL.stage(payloads, "_hist", PL.fmp_parsed("payload")["historical"])
        df = PL.stage(df, "rows", PL.fmp_rows(hist="_hist"))
        return df.withColumn("status", PL.fmp_status("payload", hist="_hist", rows="rows")).drop("_hist")
    raise ValueError(f"unknown vendor {vendor!r}")


def daily_rows(classified: DataFrame, keep_seq: bool = False) -> DataFrame:
    """Daily bars of the usable payloads: one row per (ticker, day). With
    ``keep_seq`` the row's position in its payload is kept as ``_seq``."""
    rows = (classified.where(F.col("status") == "ok")
                      .select("source", "ticker", F.inline("rows")))
    return rows.drop("_bad") if keep_seq else rows.drop("_bad", "_seq")


def rejected(classified: DataFrame, statuses, data_load=None) -> DataFrame:
    """(source, ticker, reason, payload, data_load) for the given statuses."""
    load = F.current_timestamp() if data_load is None else F.lit(data_load).cast("timestamp")
    return (classified.where(F.col("status").isin(list(statuses)))
                      .select("source", "ticker", F.col("status").alias("reason"),
                              "payload", load.alias("data_load")))
