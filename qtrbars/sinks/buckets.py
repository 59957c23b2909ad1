"""Versioned bucket tables: replace tickers while others read.

One folder per ticker means one tiny file and one commit rename per ticker:
tens of thousands per vendor, slow on any object store. Here a (source,
ticker) belongs to bucket pmod(xxhash64(source, ticker), n), and a table is

    <path>/commit=<id>/source=<s>/bucket=<b>/*.parquet    rows, never changed
    <path>/_versions/<number>.json                        the folders of a version

Replacing tickers reads the buckets they hash to, writes those anew into a
commit folder of its own and then publishes a version file that names, for
every bucket, the folder that holds it now. The version file is written aside
and renamed into place as the very last step, so

* a reader, who resolves the version once, sees all old rows or all new ones,
  and keeps seeing them however often the table is replaced meanwhile;
* a job that dies before the rename has changed nothing (``vacuum`` removes
  what it left);
* a second writer that started from the same version finds its number taken
  and raises ``ConcurrentWrite``: nothing is lost, it can start over. The rename
  refuses to overwrite; on HDFS that is atomic, on a store where it isn't,
  use one writer at a time.

A version file has one line of text per bucket and source that has rows; it is
all that the driver reads.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import BAR_SCHEMA

DEFAULT_BUCKETS = 64
BUCKET_COLS = ("source", "bucket")
#: Rows, or stored bytes, of a bucket that share a file; a larger bucket is cut between tickers.
ROWS_PER_FILE, BYTES_PER_FILE = 2_000_000, 256 << 20
#: Versions that ``vacuum`` keeps unless told otherwise.
KEEP = 2

_PLACE = re.compile(r"source=([^/]*)/bucket=(\d+)$")
_NULL = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(RuntimeError):
    """Another writer published the version that this one was to be."""


@dataclass(frozen=True)
class Version:
    """What a table consists of: folders relative to its path, and their bytes."""
    number: int
    buckets: int
    folders: dict[str, int]

    def places(self) -> dict[tuple[str | None, int], str]:
        out = {}
        for folder in self.folders:
            source, bucket = _PLACE.search(folder).groups()
            out[(None if source == _NULL else unquote(source), int(bucket))] = folder
        return out


def bucket_col(n_buckets: int = DEFAULT_BUCKETS):
    return F.pmod(F.xxhash64("source", "ticker"), F.lit(n_buckets)).cast("int")


# ------------------------------------------------------------ file system


def file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = file_system(spark, path)
    return fs.exists(hpath)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it isn't there)."""
    fs, hpath = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_new(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a file aside and rename it to ``name``, which must not be there."""
    jvm = spark.sparkContext._jvm
    fs, aside = file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), plain)
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e):
            raise ConcurrentWrite(f"{folder}/{name} was published by another writer") from None
        raise


# --------------------------------------------------------------- versions


def _root(path: str) -> str:
    return path.rstrip("/")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions still kept, oldest first."""
    return sorted(int(n[:-5]) for n in _names(spark, f"{_root(path)}/_versions") if re.fullmatch(r"\d+\.json", n))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of the table, the newest unless given (null: no table yet)."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    found = json.loads(_read_text(spark, f"{_root(path)}/_versions/{number:08d}.json"))
    return Version(number, found["buckets"], found["folders"])


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """Bucket count the table at ``path`` is stored with (null: no table yet)."""
    now = version(spark, path)
    return None if now is None else now.buckets


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Drop all but the ``keep`` newest versions and the commits that none of
    those uses; returns how many commits went. Readers of a dropped version fail, and
    so does a writer at work: call it when there is none."""
    numbers = versions(spark, path)
    kept = [version(spark, path, n) for n in numbers[-keep:]]
    used = {folder.split("/")[0] for v in kept for folder in v.folders}
    fs, _ = file_system(spark, path)
    for n in numbers[:-keep]:
        fs.delete(file_system(spark, f"{_root(path)}/_versions/{n:08d}.json")[1], False)
    gone = [c for c in _names(spark, path) if c.startswith("commit=") and c not in used]
    for commit in gone:
        fs.delete(file_system(spark, f"{_root(path)}/{commit}")[1], True)
    return len(gone)


# ---------------------------------------------------------------- reading


#: Where a row is stored: its file and its number in it.
PLACE_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("row_index", T.LongType())])


def _rows(spark: SparkSession, path: str, schema: T.StructType, folders, with_place: bool = False) -> DataFrame:
    names = [f.name for f in schema.fields]
    if not folders:
        return spark.createDataFrame([], T.StructType(schema.fields + (PLACE_SCHEMA.fields if with_place else [])))
    if with_place:
        names += [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")]
    stored = T.StructType(schema.fields + [T.StructField("commit", T.StringType()), T.StructField("bucket", T.IntegerType())])
    return (spark.read.schema(stored).option("basePath", _root(path))
            .parquet(*[f"{_root(path)}/{f}" for f in folders]).select(*names))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA,
                  tickers: list | DataFrame | None = None, source: str | None = None,
                  at: Version | None = None, with_place: bool = False) -> DataFrame:
    """Rows of the table as it is now, or in version ``at``; they stay the same
    when the table is replaced afterwards. ``with_place`` adds each row's file and
    its number in it (``row_index``).

    ``source`` and ``tickers`` (a list, or a frame with a column ``ticker``) filter each
    on its own (no ticker means no rows), and only the folders that can hold
    such rows are opened; which those are is at most as many rows as the table
    has folders.
    """
    at = at or version(spark, path)
    places = {} if at is None else at.places()
    if source is not None:
        places = {p: f for p, f in places.items() if p[0] == source}
    wanted = None
    if tickers is not None:
        if not isinstance(tickers, DataFrame):
            tickers = spark.createDataFrame([(t,) for t in tickers], "ticker string")
        wanted = tickers.select("ticker").distinct()
        sources = sorted({p[0] for p in places if p[0] is not None})
        if sources:
            each = wanted.select("ticker", F.explode(F.array(*map(F.lit, sources))).alias("source"))
            hit = each.select("source", bucket_col(at.buckets).alias("bucket")).distinct().collect()
            places = {p: places[p] for p in ((r["source"], r["bucket"]) for r in hit) if p in places}
    df = _rows(spark, path, schema, list(places.values()), with_place)
    return df if wanted is None else df.join(wanted, "ticker", "left_semi")


# ---------------------------------------------------------------- writing


def _write_commit(df: DataFrame, path: str, order, touched: int, parts: dict) -> dict[str, int]:
    """Write rows (with ``bucket``) as a commit; returns its folders and their bytes.

    A bucket is one task's work, or for the buckets in ``parts`` that many tasks',
    to which whole tickers are dealt. So a ticker lies in one file, in ``order``
    descending (its rows number as many as its quarters at most).
    """
    spark, commit = df.sparkSession, f"{_root(path)}/commit={uuid.uuid4().hex}"
    deal, tasks = list(BUCKET_COLS), min(touched, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if parts:
        cuts = F.broadcast(spark.createDataFrame([(*p, n) for p, n in parts.items()], "source string, bucket int, _parts int"))
        df = df.join(cuts, deal, "left").withColumn("_cut", F.pmod(F.hash("ticker"), F.coalesce("_parts", F.lit(1))))
        deal, tasks = [*deal, "_cut"], max(tasks, sum(parts.values()))
    sort = [*BUCKET_COLS, "ticker"] + [F.col(c).desc() for c in order if c in df.columns]
    # a fixed number of tasks, which isn't merged for being small: most of a file's cost is opening it
    (df.repartition(tasks, *deal).sortWithinPartitions(*sort).drop("_parts", "_cut")
     .write.partitionBy(*BUCKET_COLS).parquet(commit))
    out, fs = {}, file_system(spark, commit)[0]
    for source in _names(spark, commit):
        if source.startswith("source="):
            for bucket in _names(spark, f"{commit}/{source}"):
                folder = f"{commit}/{source}/{bucket}"
                size = sum(s.getLen() for s in fs.listStatus(file_system(spark, folder)[1]))
                out[folder[len(_root(path)) + 1:]] = size
    return out


@dataclass(frozen=True)
class Staged:
    """A replacement that is written but not yet published."""
    path: str
    version: Version


def stage_replace(df: DataFrame, path: str, schema: T.StructType = BAR_SCHEMA, n_buckets: int | None = None,
                  order=("quarter",), retire: DataFrame | None = None, keys: DataFrame | None = None,
                  rows_per_file: int = ROWS_PER_FILE) -> Staged | None:
    """Write the next version's changed buckets; ``publish_version`` makes it the table.

    The rows of every (source, ticker) in ``df`` and in ``retire`` give way to those of
    ``df``; retiring what isn't stored touches nothing. A caller that knows the tickers
    concerned gives them as ``keys``; then stored rows aren't searched for them, and
    ``df`` must hold no others. Null if there is nothing to change.
    """
    spark = df.sparkSession
    base = version(spark, path)
    if base is not None and n_buckets not in (None, base.buckets):
        raise ValueError(f"{path} is stored in {base.buckets} buckets, not {n_buckets}")
    n = base.buckets if base else n_buckets or DEFAULT_BUCKETS
    places = base.places() if base else {}
    names = [f.name for f in schema.fields]
    # the new rows are counted and written: computed once (again from their lineage if lost)
    new = df.select(*names, bucket_col(n).alias("bucket")).persist()
    cached = [new]
    leaving = keys is not None  # may keys hold tickers without new rows?
    if keys is None:
        keys = new.select("source", "ticker")
        if retire is not None and places:
            leaving = True
            gone = retire.select("source", "ticker").distinct().withColumn("bucket", bucket_col(n))
            held = [places[p] for p in ((r["source"], r["bucket"]) for r in gone.select(*BUCKET_COLS).distinct().collect())
                    if p in places]
            keys = keys.unionByName(_rows(spark, path, schema, held).select("source", "ticker")
                                    .join(gone, ["source", "ticker"], "left_semi"))
    keys = keys.select("source", "ticker").distinct()
    try:
        # the touched buckets and how many new rows each gets: at most one row per source and bucket
        marks = new.select(*BUCKET_COLS, F.lit(1).alias("rows"))
        if leaving:
            keys = keys.withColumn("bucket", bucket_col(n)).persist()
            cached.append(keys)
            marks = marks.unionByName(keys.select(*BUCKET_COLS, F.lit(0).alias("rows")))
        touched = {(r["source"], r["bucket"]): r["rows"]
                   for r in marks.groupBy(*BUCKET_COLS).agg(F.sum("rows").alias("rows")).collect()}
        if not touched:
            return None
        rows, old = new, [places[p] for p in sorted(touched, key=str) if p in places]
        if old:
            kept = _rows(spark, path, schema, old).join(keys.select("source", "ticker"), ["source", "ticker"], "left_anti")
            rows = kept.withColumn("bucket", bucket_col(n)).unionByName(new)
        parts = {}
        for place, count in touched.items():
            held = base.folders[places[place]] if place in places else 0
            share = count / rows_per_file + held / BYTES_PER_FILE
            if share > 1:
                parts[place] = math.ceil(share)
        folders = {f: base.folders[f] for p, f in places.items() if p not in touched}
        folders |= _write_commit(rows, path, order, len(touched), parts)
        return Staged(path, Version(base.number + 1 if base else 0, n, folders))
    finally:
        for frame in cached:
            frame.unpersist()


def publish_version(spark: SparkSession, staged: Staged | None) -> Version | None:
    """Make a staged replacement the table's newest version; raises
    ``ConcurrentWrite`` if another writer came first."""
    if staged is None:
        return None
    v = staged.version
    text = json.dumps({"buckets": v.buckets, "folders": v.folders}, indent=0)
    _write_new(spark, f"{_root(staged.path)}/_versions", f"{v.number:08d}.json", text)
    return v


def replace_in_buckets(df: DataFrame, path: str, schema: T.StructType = BAR_SCHEMA,
                       n_buckets: int | None = None, order=("quarter",),
                       retire: DataFrame | None = None, keys: DataFrame | None = None,
                       rows_per_file: int = ROWS_PER_FILE) -> Version | None:
    """Replace the rows of every (source, ticker) in ``df`` in the table at
    ``path`` and remove those of the stored (source, ticker) in ``retire``; all
    other tickers keep their rows. See ``stage_replace``.

    The first write fixes the bucket count (``n_buckets``, 64 unless given);
    asking for another one later raises.
    """
    return publish_version(df.sparkSession, stage_replace(df, path, schema, n_buckets, order, retire, keys, rows_per_file))
