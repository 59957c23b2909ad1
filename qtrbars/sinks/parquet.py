"""Replace-by-ticker parquet sinks.

The default layout is the versioned bucket table of ``buckets.py``. In the
other, bars (and the not-available / quarantine records) are stored partitioned
by ``source`` and ``ticker``, one folder for each ticker. Writing uses dynamic partition overwrite: only the
(source, ticker) folders present in the new data are replaced; every other
ticker's folder is untouched, so re-running a ticker replaces exactly its
files and a second identical run changes nothing. Rows are sorted newest
quarter first inside each ticker.

Before writing, rows are redistributed with a ``rebalance`` hint on the
partition columns: AQE groups small partitions together (about one file per
folder instead of one per task and folder) and splits a skewed folder over
several tasks, so a ticker or bucket holding a third of the rows is not
written by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the versioned bucket tables and all schemas are part of this module's interface
from .buckets import (ConcurrentWrite, Version, bucket_col, exists, publish_version, read_bucketed,  # noqa: F401
                      replace_in_buckets, stage_replace, stored_buckets, vacuum, version, versions)
from .schemas import BAR_SCHEMA, INDEX_SCHEMA, MANIFEST_SCHEMA, RECORD_SCHEMA  # noqa: F401

PARTITION_COLS = ("source", "ticker")


def replace_by_ticker(df: DataFrame, path: str, order=("quarter",),
                      partition_cols=PARTITION_COLS) -> None:
    """Write ``df`` so that each (source, ticker) present replaces its old
    folder and all other folders stay."""
    sort = [*partition_cols] + [F.col(c).desc() for c in order if c in df.columns]
    (df.hint("rebalance", *partition_cols)
       .sortWithinPartitions(*sort)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))


def write_records(records: DataFrame, path: str) -> None:
    """Not-available registry / quarantine: one record per ticker, replaced
    on re-run like the bars."""
    replace_by_ticker(records, path, order=())


def read_table(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """Read a sink back with its declared schema (partition values stay text,
    so a ticker such as '123' is not turned into a number)."""
    return spark.read.schema(schema).parquet(path)
