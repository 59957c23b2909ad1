"""Composed pipelines: what a user of the engine calls.

daily_to_quarterly  daily bars (any vendor) -> canonical quarterly bars + returns
av_quarterly        AV payload folder -> bars, registry, quarantine
fmp_quarterly       FMP payload folder -> bars, registry, quarantine
yahoo_quarterly     long 3-month vendor bars -> cleaned bars (+ _from_wide)
universe            security parquet files -> cleaned, remapped tickers
publish             replace stored bars / records ticker by ticker (+ manifest)
publish_yahoo       the same for Yahoo bars and rejected tickers
pending_work        universe minus published bars and registered tickers, from the key index
repo_summary        repository JSON + contributor lists -> stars and contributor count

Plan shape of daily_to_quarterly (checked with explain): scan -> partial
aggregate -> exchange on (ticker, quarter_start) -> final aggregate ->
exchange on ticker -> window -> output. The second exchange moves quarterly
rows only (one per ticker and quarter). Repartitioning daily rows by ticker
first would save that exchange but shuffle every raw row without map-side
combine and put a hot ticker's raw rows in one task, so it is not done.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, quarter_end_offset, quarter_label
from ..operators.bars import BAR_COLUMNS, quarterly_bars
from ..operators.quality import default_missing, drop_incomplete, price_gate
from ..operators.returns import trading_span, with_compound_return, with_pct_change, with_returns
from ..operators.universe import normalize_tickers, pending_tickers, ticker_universe
from ..functions import payload as PLF
from ..sources import payloads as SRC


def universe(spark, prices_path: str, mapping_path: str, digits: str = "any",
             aliases: dict | None = None, key: str = "cusip") -> DataFrame:
    """Tickers of the securities with prices: DISTINCT keys of the price file
    semi-joined to DISTINCT (key, ticker) of the mapping file, then filtered
    and remapped, in symbol order. Only the key / ticker columns are read
    (column pruning)."""
    prices = spark.read.parquet(prices_path).select(key)
    mapping = spark.read.parquet(mapping_path).select(key, "ticker")
    return normalize_tickers(ticker_universe(prices, mapping, key=key), "ticker",
                             digits=digits, aliases=aliases).orderBy("ticker")


def _data_load(data_load) -> Column:
    if data_load is None:
        return F.current_timestamp()
    return data_load if isinstance(data_load, Column) else F.lit(data_load).cast("timestamp")


def daily_to_quarterly(daily: DataFrame, source: str, actions: bool = True,
                       order: Column | None = None, data_load=None) -> DataFrame:
    """Daily bars -> canonical quarterly bars with pct_change and
    compound_return, newest quarter first within a ticker when written."""
    bars = quarterly_bars(daily, keys=("ticker",), date="date", order=order, actions=actions)
    bars = with_returns(bars, keys=("ticker",), order="quarter_start", method="diff")
    if not actions:
        bars = (bars.withColumn("dividend_amount", F.lit(None).cast("double"))
                    .withColumn("split_coefficient", F.lit(None).cast("double")))
    return (bars.withColumn("source", F.lit(source))
                .withColumn("data_load", _data_load(data_load))
                .select(*BAR_COLUMNS))


# ---------------------------------------------------------------- Yahoo

YAHOO_OPTIONAL_DEFAULTS = {"stock_splits": 0.0, "dividends": 0.0}


def yahoo_quarterly(long: DataFrame, source: str = "YAHOO", data_load=None,
                    complete_flag: str = "_complete") -> tuple[DataFrame, DataFrame]:
    """Cleaned 3-month vendor bars -> canonical bars, plus rejected tickers.

    ``long`` has ticker, date, the required fields and optionally dividends,
    stock_splits, capital_gains and a per-row completeness flag (from
    ``wide_to_long``). Steps: drop incomplete rows, default the optional
    columns to 0.0, drop capital gains, reject whole tickers with any adjusted
    close <= 0, label the quarter from the bar date, move the date to the
    next quarter end (a bar dated on a quarter end moves one quarter on),
    truncate volume to an integer, then returns (ratio form) oldest-first.
    """
    if complete_flag in long.columns:
        rows = long.where(F.col(complete_flag)).drop(complete_flag)
    else:
        # every field the frame carries must be present, as in the vendor frame
        rows = drop_incomplete(long, [c for c in long.columns if c not in ("ticker", "date")])
    rows = default_missing(rows, YAHOO_OPTIONAL_DEFAULTS).drop("capital_gains")
    # bars: one row per quarter per ticker, so the gate is a bounded window
    passed, rejected = price_gate(rows, "ticker", "adj_close", bounded_groups=True)
    bars = passed.select(
        F.col("ticker"),
        quarter_label("date").alias("quarter"),
        "open", "high", "low", "close",
        F.col("adj_close").alias("adjusted_close"),
        F.col("volume").try_cast("bigint").alias("volume"),
        F.col("dividends").alias("dividend_amount"),
        F.col("stock_splits").alias("split_coefficient"),
        quarter_end_offset("date").alias("date"),
        as_date("date").alias("_bar_date"),
    )
    bars = with_pct_change(bars, "ticker", order="_bar_date", method="ratio")
    bars = with_compound_return(bars, "ticker", order="_bar_date")
    bars = (bars.withColumn("source", F.lit(source))
                .withColumn("data_load", _data_load(data_load))
                .select(*BAR_COLUMNS))
    rejected = rejected.select(F.lit(source).alias("source"), "ticker",
                               F.lit("nonpositive_price").alias("reason"))
    return bars, rejected


# ------------------------------------------------------ AV / FMP payloads

QUARANTINE_STATUSES = ("unparseable", "unrecognized")


def process_payloads(payloads: DataFrame, vendor: str, data_load=None,
                     cache: bool = False) -> dict:
    """Classified payload rows -> the job's outputs.

    bars          canonical quarterly bars of the usable payloads
    not_available registry of tickers the vendor does not know
    quarantine    payloads that could not be used (unparseable, unrecognized)
    retry         tickers answered with a rate-limit message (stay pending)
    """
    classified = SRC.classify(payloads, vendor)
    if cache:  # bars, registry, quarantine and retry all read it
        classified = classified.persist()
    daily = SRC.daily_rows(classified, keep_seq=True)
    bars = daily_to_quarterly(daily, vendor, actions=(vendor == "AV"), data_load=data_load,
                              order=PLF.row_order("date", "_seq"))
    return {
        "bars": bars,
        "not_available": SRC.rejected(classified, ["not_available"], data_load),
        "quarantine": SRC.rejected(classified, QUARANTINE_STATUSES, data_load),
        "retry": classified.where(F.col("status") == "rate_limited").select("source", "ticker"),
        "classified": classified.select("source", "ticker", "path", "status"),
        "classified_frame": classified,
        "source": vendor,
    }


def yahoo_quarterly_from_wide(spark, path: str, fmt: str = "parquet", index: str = "Date",
                              source: str = "YAHOO", data_load=None):
    """Landed wide 3-month table (one row per date) -> (bars, rejected tickers).

    ``fmt='csv2'``: CSV files with a header of two rows, each with columns of its
    own (``sources.wide``). Otherwise files of one schema with ``TICKER|Field``
    columns."""
    from ..operators.reshape import wide_to_long
    from ..sources.wide import read_wide_csv
    if fmt == "csv2":
        return yahoo_quarterly(read_wide_csv(spark, path), source, data_load)
    wide = spark.read.format(fmt).option("header", True).load(path)
    return yahoo_quarterly(wide_to_long(wide, index=index), source, data_load)


def av_quarterly(spark, landing: str, data_load=None, latest_only: bool = True) -> dict:
    """AV daily CSV payloads (one file per ticker) -> outputs of
    ``process_payloads``."""
    return process_payloads(SRC.read_payloads(spark, landing, "AV", latest_only=latest_only),
                            "AV", data_load)


def fmp_quarterly(spark, landing: str, data_load=None, latest_only: bool = True) -> dict:
    """FMP JSON payloads (one file per ticker) -> outputs of ``process_payloads``."""
    return process_payloads(SRC.read_payloads(spark, landing, "FMP", latest_only=latest_only),
                            "FMP", data_load)


def manifest(bars: DataFrame) -> DataFrame:
    """(source, ticker, first_quarter, last_quarter) of the priced quarters:
    the span the source job put into its file names, kept as a table."""
    return trading_span(bars, keys=("source", "ticker"))


#: Where the answers of a status are stored (rate-limited ones nowhere).
STATES = {"ok": "bars", "not_available": "not_available", "unparseable": "quarantine", "unrecognized": "quarantine"}


def index_path(bars_path: str) -> str:
    """Where the key index of a lake is kept: beside its bars."""
    return bars_path.rstrip("/") + "_index"


def payload_digest(payload: str) -> Column:
    """What tells a ticker's answers apart (a null payload is its own kind)."""
    return F.coalesce(F.sha2(payload, 256), F.lit(""))


def answers(classified: DataFrame) -> DataFrame:
    """Index rows (source, ticker, state, modified, fetch_id, path, digest) of classified payloads."""
    state = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])[F.col("status")]
    have = set(classified.columns)
    return classified.where(F.col("status") != "rate_limited").select(
        "source", "ticker", state.alias("state"), "modified",
        (F.col("fetch_id") if "fetch_id" in have else F.lit(None)).cast("bigint").alias("fetch_id"), "path",
        (F.col("digest") if "digest" in have else payload_digest("payload")).alias("digest"))


def _with_prior(spark, found: DataFrame, bars_path: str, source: str | None) -> DataFrame:
    """Index rows with ``was``: where the ticker has been stored so far (null: nowhere)."""
    from ..sinks import parquet as SK
    prior = SK.read_bucketed(spark, index_path(bars_path), SK.INDEX_SCHEMA, source=source)
    return found.join(prior.select("source", "ticker", F.col("state").alias("was")), ["source", "ticker"], "left")


def publish(outputs: dict, bars_path: str, registry_path: str, quarantine_path: str,
            layout: str = "bucket", manifest_path: str | None = None, refreshed: DataFrame | None = None) -> None:
    """Replace the stored bars/records of every ticker present in the outputs.

    ``layout='bucket'`` (default) keeps versioned bucket tables and writes anew only
    touched buckets; a ticker is then found in one place only (bars, registry or
    quarantine), that of its answer published last. A rate-limit message is no
    answer and changes nothing. Which place that is, the fetch and the digest
    of its text stand in the key index (``index_path``), written last: it
    says which buckets a ticker has to leave, so no stored rows are searched.
    ``refreshed`` are index rows of answers whose text is the one already
    stored; they replace index rows only. ``layout='ticker'`` keeps one folder per
    ticker, as the source job's one-file-per-ticker output does, and replaces
    folders without removing any.

    The classified payloads are kept while publishing, so the landing is read
    and parsed once for all outputs."""
    from ..sinks import parquet as SK
    if layout not in ("bucket", "ticker"):
        raise ValueError("layout must be 'bucket' or 'ticker'")
    frame = outputs["classified_frame"]
    spark = frame.sparkSession
    cached = [] if frame.storageLevel.useMemory or frame.storageLevel.useDisk else [frame.persist()]
    try:
        found = answers(frame)
        if layout == "bucket":
            moves = _with_prior(spark, found, bars_path, outputs.get("source")).select("source", "ticker", "state", "was").persist()
            bars = outputs["bars"].persist()  # the manifest is read from them, too
            cached += [moves, bars]
            _replace_moved(moves, {
                "bars": [(bars, bars_path, SK.BAR_SCHEMA, ("quarter",))]
                + ([(manifest(bars), manifest_path, SK.MANIFEST_SCHEMA, ())] if manifest_path else []),
                "not_available": [(outputs["not_available"], registry_path, SK.RECORD_SCHEMA, ())],
                "quarantine": [(outputs["quarantine"], quarantine_path, SK.RECORD_SCHEMA, ())]})
        else:
            SK.replace_by_ticker(outputs["bars"], bars_path)
            SK.write_records(outputs["not_available"], registry_path)
            SK.write_records(outputs["quarantine"], quarantine_path)
            if manifest_path:
                SK.replace_in_buckets(manifest(outputs["bars"]), manifest_path, SK.MANIFEST_SCHEMA, order=(),
                                      retire=frame.where(~F.col("status").isin("ok", "rate_limited")))
        rows = found if refreshed is None else found.unionByName(refreshed)
        SK.replace_in_buckets(rows, index_path(bars_path), SK.INDEX_SCHEMA, order=())
    finally:
        for one in cached:
            one.unpersist()


def _replace_moved(moves: DataFrame, tables: dict) -> None:
    """Replace, in each state's tables, the tickers that are now there or were.

    The tables don't depend on each other, so their jobs run side by side; the
    first failure is raised when all have ended."""
    from ..sinks import parquet as SK

    @inheritable_thread_target(moves.sparkSession)
    def replace(state: str, rows: DataFrame, path: str, schema, order) -> None:
        keys = moves.where((F.col("state") == state) | (F.col("was") == state))
        SK.replace_in_buckets(rows, path, schema, order=order, keys=keys)

    moves.count()  # cached before the tables' jobs ask for it at once
    jobs = [(state, *target) for state, targets in tables.items() for target in targets]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for done in [pool.submit(replace, *job) for job in jobs]:
            done.result()


def publish_yahoo(bars: DataFrame, rejected: DataFrame, bars_path: str, quarantine_path: str,
                  manifest_path: str | None = None, data_load=None) -> None:
    """Replace the stored Yahoo bars; rejected tickers go to the common
    quarantine (no payload text, reason ``nonpositive_price``) and lose stored
    bars, tickers with bars leave the quarantine. Their index rows have no
    fetch and no digest."""
    from ..sinks import parquet as SK
    spark = bars.sparkSession
    load = _data_load(data_load)
    records = rejected.select(F.col("reason"), F.lit(None).cast("string").alias("payload"),
                              load.alias("data_load"), "source", "ticker")
    found = (bars.select("source", "ticker", F.lit("bars").alias("state"))
             .unionByName(rejected.select("source", "ticker", F.lit("quarantine").alias("state"))).distinct())
    moves = _with_prior(spark, found, bars_path, None).persist()
    try:
        _replace_moved(moves, {
            "bars": [(bars, bars_path, SK.BAR_SCHEMA, ("quarter",))]
            + ([(manifest(bars), manifest_path, SK.MANIFEST_SCHEMA, ())] if manifest_path else []),
            "quarantine": [(records, quarantine_path, SK.RECORD_SCHEMA, ())]})
        none = F.lit(None)
        SK.replace_in_buckets(moves.select("source", "ticker", "state", load.alias("modified"), none.cast("bigint").alias("fetch_id"),
                                           none.cast("string").alias("path"), none.cast("string").alias("digest")),
                              index_path(bars_path), SK.INDEX_SCHEMA, order=())
    finally:
        moves.unpersist()


def pending_work(spark, universe: DataFrame, bars_path: str, source: str) -> DataFrame:
    """Tickers of ``universe`` that still need a fetch from ``source``: neither bars
    nor registered as unknown. Rate-limited tickers were never stored and
    quarantined ones have nothing usable, so both stay pending.

    Only the key index is read, one short row per ticker, never the bars; and of
    it only this source's folders."""
    from ..sinks import parquet as SK
    index = SK.read_bucketed(spark, index_path(bars_path), SK.INDEX_SCHEMA, source=source)
    return pending_tickers(universe, index.where(F.col("state").isin("bars", "not_available")).select("ticker"))


# ------------------------------------------------------- repository summary

REPO_SCHEMA = "struct<stargazers_count:bigint, contributors_url:string>"


def repo_summary(repos: DataFrame, contributors: DataFrame) -> DataFrame:
    """Repository payloads (``payload``: JSON object) and contributor-list
    payloads (``url``, ``payload``: JSON array) -> (contributors_url,
    stargazers_count, contributors). The second fetch depends on a field of
    the first, so the lists are joined on the URL read from each repository;
    both sides carry one row per URL, so no key can be hot. A repository whose
    list is missing, or that names none (these skip the join), keeps a null count."""
    r = (repos.select(F.from_json("payload", REPO_SCHEMA).alias("r"))
              .select("r.contributors_url", "r.stargazers_count"))
    c = contributors.select(F.col("url").alias("contributors_url"),
                            F.json_array_length("payload").cast("bigint").alias("contributors"))
    named = r.where(F.col("contributors_url").isNotNull()).join(c, "contributors_url", "left")
    return named.unionByName(r.where(F.col("contributors_url").isNull()), allowMissingColumns=True)
