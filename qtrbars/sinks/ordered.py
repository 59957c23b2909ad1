"""Totally ordered tables with positions, written once and resumed anywhere.

    <path>/rows/part-*.parquet    range-partitioned and sorted: file k's rows precede file k + 1's
    <path>/_index/                one row per file: its rows, the position of its first,
                                  its least and greatest first order column

A row's position is its file's start plus its number in the file, so neither
reading positions nor resuming after the first n rows sorts or counts
anything again: files before position n aren't opened. The index is written
last; its size is the number of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .buckets import exists


def _file():
    return F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1)


def write_ordered(df: DataFrame, path: str, order: list[str], files: int | None = None) -> None:
    """Write ``df`` in ``order`` (ascending, nulls first), ties by a hash of the whole
    row, so that a frequent value spreads over files as far as its rows differ.

    ``files``: how many there are at most (the session's shuffle partitions).
    """
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*map(F.col, order), F.xxhash64(*df.columns)]
    df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.parquet(f"{path}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows").select(
        _file().alias("file"), F.col("_metadata.row_index").alias("at"), F.col(order[0]).alias("key"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    # one row a file: the first and the last of each are its least and greatest
    ends = rows.join(F.broadcast(counts), "file").where((F.col("at") == 0) | (F.col("at") == F.col("rows") - 1))
    index = ends.groupBy("file", "rows").agg(F.min("key").alias("least"), F.max("key").alias("greatest"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)  # over the files
    (index.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/_index"))


def ordered_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, least, greatest, start) of each file that has rows."""
    if not exists(spark, f"{path}/_index/_SUCCESS"):
        raise FileNotFoundError(f"{path} isn't a completely written ordered table")
    return spark.read.parquet(f"{path}/_index")


def read_ordered(spark: SparkSession, path: str, skip: int = 0, key: str | None = None, least=None, greatest=None,
                 out: str = "position") -> DataFrame:
    """Rows after the first ``skip`` with their position (from 0), between ``least`` and
    ``greatest`` of the first order column, named ``key``, where given (ends included);
    only files that can hold such rows are opened."""
    files = ordered_files(spark, path)
    kept = files.where(F.col("start") + F.col("rows") > skip)
    if least is not None:
        kept = kept.where(F.col("greatest") >= F.lit(least))
    if greatest is not None:
        kept = kept.where(F.col("least") <= F.lit(greatest))
    named = [r["file"] for r in kept.select("file").collect()]  # as many as files at most
    schema = spark.read.parquet(f"{path}/rows").schema
    if not named:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(out, T.LongType())]))
    rows = (spark.read.schema(schema).parquet(*[f"{path}/rows/{f}" for f in sorted(named)])
            .select("*", _file().alias("_file"), F.col("_metadata.row_index").alias("_at"))
            .join(F.broadcast(files.select(F.col("file").alias("_file"), F.col("start").alias("_start"))), "_file")
            .withColumn(out, F.col("_start") + F.col("_at")).where(F.col(out) >= skip).drop("_file", "_at", "_start"))
    if least is not None:
        rows = rows.where(F.col(key) >= F.lit(least))
    if greatest is not None:
        rows = rows.where(F.col(key) <= F.lit(greatest))
    return rows
