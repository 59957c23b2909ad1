"""Landed wide tables as CSV text with a header of two rows.

    Ticker,AAA,AAA,BBB,BBB          which symbol a column belongs to
    Price,Open,Close,Open,Close     which field it is
    Date,,,,                        (a row that names the index may follow)
    2024-01-01,10,11,20,21

A vendor batch of some thousand symbols has tens of thousands of columns, and
every file has its own. So columns are data here, not schema: a file's header
becomes one array of (position, symbol, field), each of its lines is cut into
cells once, and cells become rows by explode. The plan is the same however
many columns there are; what is shuffled is lines and headers, by file. Symbol
and field names and their number are taken from the headers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import payload as PL
from ..functions.dates import parse_day
from ..operators.reshape import fields_side_by_side


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, modified, line, at, day): ``at`` orders a file's first lines; ``day`` is null for headers."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("at"))
    first = F.trim(F.replace(F.regexp_extract("line", "^[^,]*", 0), F.lit('"'), F.lit("")))
    return raw.withColumn("day", F.coalesce(parse_day(F.substring(first, 1, 10)), F.lit(None).cast("date")))


def headers(lines: DataFrame) -> DataFrame:
    """(file, pos, ticker, field) of every column; of a symbol in several files
    the newest file's alone (landing time, then path)."""
    top = Window.partitionBy("file").orderBy("at")
    rows = (lines.where(F.col("day").isNull() & (F.col("block") == 0) & (F.trim("line") != ""))
            .withColumn("n", F.row_number().over(top)).where("n <= 2"))  # at most two lines a file
    cells = rows.select("file", "modified", "n", F.posexplode(PL.csv_cells(PL.shielded("line"))).alias("pos", "name"))
    columns = (cells.where("pos > 0").groupBy("file", "modified", "pos")
               .agg(F.max(F.when(F.col("n") == 1, F.col("name"))).alias("ticker"),
                    F.max(F.when(F.col("n") == 2, F.col("name"))).alias("field"))
               .where((F.col("ticker") != "") & (F.col("field") != "")))
    newest = columns.groupBy("ticker").agg(F.max(F.struct("modified", "file")).alias("newest"))
    kept = columns.join(newest.select("ticker", F.col("newest.file").alias("file")), ["ticker", "file"], "left_semi")
    return kept.select("file", "pos", "ticker", F.replace(F.lower("field"), F.lit(" "), F.lit("_")).alias("field"))


def wide_cells(lines: DataFrame, columns: DataFrame) -> DataFrame:
    """(ticker, date, _field, _value) of every cell; a malformed number or NaN counts as missing."""
    header = columns.groupBy("file").agg(F.collect_list(F.struct("pos", "ticker", "field")).alias("columns"))
    cut = lines.where(F.col("day").isNotNull()).select("file", "day", PL.csv_cells(PL.shielded("line")).alias("cells"))
    picked = F.transform("columns", lambda c: F.struct(
        c["ticker"].alias("ticker"), c["field"].alias("_field"), F.get(F.col("cells"), c["pos"]).alias("text")))
    each = cut.join(header, "file").select(F.col("day").alias("date"), F.inline(picked))
    return each.select("ticker", "date", "_field",
                       F.nanvl(F.col("text").try_cast("double"), F.lit(None).cast("double")).alias("_value"))


def read_wide_csv(spark: SparkSession, path: str, complete_flag: str = "_complete") -> DataFrame:
    """One row per (ticker, date) with a column for each field that any header
    names; ``complete_flag`` is true where all fields that the symbol's file has are there.

    A field that no header names is no column; one that only some symbols have is
    null for the others. Lines without a date are skipped.
    """
    lines = _lines(spark, path)
    columns = headers(lines)
    # the distinct fields of a vendor's tables: some ten
    fields = [r["field"] for r in columns.groupBy("field").agg(F.min("pos").alias("p")).orderBy("p", "field").collect()]
    return fields_side_by_side(wide_cells(lines, columns), fields, complete_flag)
