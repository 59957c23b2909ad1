"""Driver queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (through the stand-ins of
``standins.py``) and returns deterministic columns whose names match the SQL
in ``oracle.py``. Time-of-run columns (``data_load``) are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import payload as PL
from ..functions.tickers import keep_ticker, remap_alias
from ..operators import quality as Q
from ..operators import reshape as RS
from ..operators import returns as R
from ..operators import universe as U
from ..operators.bars import quarterly_bars, split_coefficient_agg
from ..session import scratch_path
from ..sinks import ordered as OT
from ..sinks import parquet as SK
from ..sources import payloads as SRC
from ..sources import wide as WIDE
from ..streaming import ingest as ING
from . import pipelines as P
from . import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("quarterly_bars_av")
def quarterly_bars_av(spark, sf_dir):
    daily = S.daily_from_lineitem(S.table(spark, sf_dir, "lineitem"))
    return P.daily_to_quarterly(daily, "AV", actions=True, order=daily["_order"]).drop("data_load")


@query("quarterly_bars_fmp")
def quarterly_bars_fmp(spark, sf_dir):
    daily = S.daily_from_orders(S.table(spark, sf_dir, "orders"))
    return P.daily_to_quarterly(daily, "FMP", actions=False, order=daily["_order"]).drop("data_load")


# ------------------------------------------------------------ Yahoo bars


@query("quarterly_bars_yahoo")
def quarterly_bars_yahoo(spark, sf_dir):
    long = S.yahoo_bars_from_lineitem(S.table(spark, sf_dir, "lineitem"))
    bars, _rejected = P.yahoo_quarterly(long)
    return bars.drop("data_load")


# -------------------------------------------------------------- universe

def _universe(spark, sf_dir, keep_key=False):
    prices, mapping = S.security_tables(spark, sf_dir)
    return U.ticker_universe(prices, mapping, key="cusip", ticker="ticker", keep_key=keep_key)


@query("ticker_universe")
def ticker_universe(spark, sf_dir):
    return _universe(spark, sf_dir)


@query("ticker_normalize")
def ticker_normalize(spark, sf_dir):
    return U.normalize_tickers(_universe(spark, sf_dir), "ticker", digits="any")


@query("ticker_normalize_leading")
def ticker_normalize_leading(spark, sf_dir):
    return U.normalize_tickers(_universe(spark, sf_dir), "ticker", digits="leading")


@query("distinct_tickers")
def distinct_tickers(spark, sf_dir):
    return U.distinct_tickers(U.normalize_tickers(_universe(spark, sf_dir)))


@query("ticker_sample")
def ticker_sample(spark, sf_dir):
    clean = U.distinct_tickers(U.normalize_tickers(_universe(spark, sf_dir)))
    return U.sample_tickers(clean, 30, seed=42)


@query("batch_round_robin")
def batch_round_robin(spark, sf_dir):
    # positions follow the sorted raw symbols; aliases are rewritten after
    kept = _universe(spark, sf_dir, keep_key=True).where(keep_ticker("ticker"))
    batches = U.round_robin_batches(kept, 7, order=["ticker"])
    return batches.select(remap_alias("ticker").alias("ticker"), "batch")


@query("universe_offset")
def universe_offset(spark, sf_dir):
    kept = _universe(spark, sf_dir, keep_key=True).where(keep_ticker("ticker"))
    rest = U.skip_first(kept, 100, order=["ticker"])
    return rest.select(remap_alias("ticker").alias("ticker"))


def _ordered_universe(spark, sf_dir, name):
    path = scratch_path(spark, name)
    OT.write_ordered(_universe(spark, sf_dir, keep_key=True), path, ["ticker"])
    return path


@query("universe_positions")
def universe_positions(spark, sf_dir):
    """The universe in symbol order with each row's position."""
    path = _ordered_universe(spark, sf_dir, "universe_positions")
    return OT.read_ordered(spark, path).select("ticker", "position")


@query("universe_resume")
def universe_resume(spark, sf_dir):
    """The universe after its first 1,000 rows: files before are not opened."""
    path = _ordered_universe(spark, sf_dir, "universe_resume")
    return OT.read_ordered(spark, path, skip=1000).select("ticker", "position")


def _fmp_bars(spark, sf_dir):
    daily = S.daily_from_orders(S.table(spark, sf_dir, "orders"))
    return P.daily_to_quarterly(daily, "FMP", actions=False, order=F.col("_order"))


@query("pending_tickers")
def pending_tickers(spark, sf_dir):
    """Customers' and suppliers' tickers without a bar."""
    customers = S.table(spark, sf_dir, "customer").select(U.ticker_col("C", "c_custkey").alias("ticker"))
    suppliers = S.table(spark, sf_dir, "supplier").select(U.ticker_col("S", "s_suppkey").alias("ticker"))
    daily = S.daily_from_orders(S.table(spark, sf_dir, "orders"))
    done = quarterly_bars(daily, order=F.col("_order"), actions=False).select("ticker")
    return U.pending_tickers(customers.unionByName(suppliers), done)


def _published(spark, sf_dir, name):
    """A lake of the newest answer to each customer: bars, unknown tickers, quarantine."""
    base = scratch_path(spark, name)
    paths = {k: f"{base}/{k}" for k in ("bars", "not_available", "quarantine", "manifest")}
    newest = SRC.newest_per_ticker(S.order_answers(S.table(spark, sf_dir, "orders")), ("modified", "fetch_id"), "AV")
    out = P.process_payloads(newest, "AV", data_load="2024-01-01 00:00:00")
    P.publish(out, paths["bars"], paths["not_available"], paths["quarantine"], manifest_path=paths["manifest"])
    return paths


@query("pending_work")
def pending_work(spark, sf_dir):
    """Customers that still need a fetch, from the key index of published answers."""
    paths = _published(spark, sf_dir, "pending_work")
    universe = S.table(spark, sf_dir, "customer").select(U.ticker_col("C", "c_custkey").alias("ticker"))
    return P.pending_work(spark, universe, paths["bars"], "AV")


@query("not_available_sink")
def not_available_sink(spark, sf_dir):
    """The registry as it is stored, with its load time."""
    paths = _published(spark, sf_dir, "not_available_sink")
    return SK.read_bucketed(spark, paths["not_available"], SK.RECORD_SCHEMA).select(
        "source", "ticker", "reason", "payload", F.date_format("data_load", "yyyy-MM-dd HH:mm:ss").alias("data_load"))


@query("trading_span")
def trading_span(spark, sf_dir):
    return R.trading_span(_fmp_bars(spark, sf_dir))


@query("latest_quarters")
def latest_quarters(spark, sf_dir):
    bars = _fmp_bars(spark, sf_dir)
    cols = ["adjusted_close", "pct_change", "compound_return"]
    # one numeric pick per column (a struct would make the aggregate sort)
    latest = bars.groupBy("ticker").agg(F.max("date").alias("_d"),
                                        *[F.max_by(c, F.col("date")).alias(c) for c in cols])
    return latest.select("ticker", D.quarter_label("_d").alias("quarter"), *cols)


# ----------------------------------------------------------- gate, any/all

@query("price_gate")
def price_gate(spark, sf_dir):
    cust = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    passed, _bad = Q.price_gate(cust, ["c_nationkey", "c_mktsegment"], "c_acctbal")
    return passed


@query("any_all")
def any_all(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.groupBy("user_id").agg(
        Q.any_of(F.col("event_type") == "error").alias("any_error"),
        Q.any_of(F.col("props").contains('"k": 9')).alias("any_k9"),
        Q.all_of(F.col("value") > 0).alias("all_positive"),
        Q.all_of(F.col("value") > 1).alias("all_over_one"))


# ------------------------------------------------------- quarter calendar

def _order_dates(spark, sf_dir):
    return (S.table(spark, sf_dir, "orders")
            .select(D.as_date("o_orderdate").alias("d")).distinct())


@query("quarter_end_date")
def quarter_end_date(spark, sf_dir):
    return _order_dates(spark, sf_dir).select("d", D.quarter_end("d").alias("quarter_end"))


@query("quarter_label")
def quarter_label(spark, sf_dir):
    return _order_dates(spark, sf_dir).select("d", D.quarter_label("d").alias("quarter"))


@query("quarter_end_offset")
def quarter_end_offset(spark, sf_dir):
    return _order_dates(spark, sf_dir).select("d", D.quarter_end_offset("d").alias("offset_end"))


# -------------------------------------------------------- split, windows

@query("split_coefficient")
def split_coefficient(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    split = F.when(F.col("l_quantity") > 45, F.col("l_quantity") / 10).otherwise(F.lit(1.0))
    return (li.groupBy(U.ticker_col("S", "l_suppkey").alias("ticker"),
                       D.quarter_label("l_shipdate").alias("quarter"))
              .agg(split_coefficient_agg(split).alias("split_coefficient")))


def _av_bars(spark, sf_dir):
    daily = S.daily_from_lineitem(S.table(spark, sf_dir, "lineitem"))
    return quarterly_bars(daily, order=F.col("_order"))


@query("pct_change")
def pct_change(spark, sf_dir):
    b = R.with_pct_change(_av_bars(spark, sf_dir), "ticker", "quarter_start", method="diff")
    return b.select("ticker", "quarter", "pct_change")


@query("pct_change_desc")
def pct_change_desc(spark, sf_dir):
    b = R.with_pct_change(_av_bars(spark, sf_dir), "ticker", "quarter_start", method="ratio")
    return b.select("ticker", "quarter", "pct_change")


@query("compound_return")
def compound_return(spark, sf_dir):
    b = R.with_compound_return(_av_bars(spark, sf_dir), "ticker", "quarter_start")
    return b.select("ticker", "quarter", "compound_return")


# ---------------------------------------------------------------- payloads


def _event_classified(spark, sf_dir):
    return SRC.classify(S.event_payloads(S.table(spark, sf_dir, "events")), "AV")


@query("payload_classify")
def payload_classify(spark, sf_dir):
    return _event_classified(spark, sf_dir).select("ticker", "status")


@query("payload_quarantine")
def payload_quarantine(spark, sf_dir):
    return (SRC.rejected(_event_classified(spark, sf_dir), P.QUARANTINE_STATUSES)
            .drop("data_load"))


@query("not_available_registry")
def not_available_registry(spark, sf_dir):
    return SRC.rejected(_event_classified(spark, sf_dir), ["not_available"]).drop("data_load")


@query("csv_payload_parse")
def csv_payload_parse(spark, sf_dir):
    c = SRC.classify(S.order_csv_payloads(S.table(spark, sf_dir, "orders")), "AV")
    return SRC.daily_rows(c)


@query("csv_quoted_records")
def csv_quoted_records(spark, sf_dir):
    """Records with quoted cells that hold commas, quotes and line breaks."""
    c = SRC.classify(S.order_quoted_payloads(S.table(spark, sf_dir, "orders")), "AV")
    return SRC.daily_rows(c)


@query("volume_limit")
def volume_limit(spark, sf_dir):
    """Volumes at the 64-bit limit: the exact sum is kept, one more is refused."""
    out = P.process_payloads(S.order_volume_payloads(S.table(spark, sf_dir, "orders")), "AV")
    bars = out["bars"].select("ticker", F.lit("ok").alias("status"), F.col("volume").cast("string").alias("volume"))
    refused = out["quarantine"].select("ticker", F.col("reason").alias("status"), F.lit(None).cast("string").alias("volume"))
    return bars.unionByName(refused)


@query("json_records_explode")
def json_records_explode(spark, sf_dir):
    c = SRC.classify(S.order_json_payloads(S.table(spark, sf_dir, "orders")), "FMP")
    return SRC.daily_rows(c)


@query("json_history_records")
def json_history_records(spark, sf_dir):
    """Payloads of many records: each record's place in its payload is kept."""
    c = SRC.classify(S.customer_json_payloads(S.table(spark, sf_dir, "orders")), "FMP")
    return SRC.daily_rows(c, keep_seq=True).withColumnRenamed("_seq", "place")


@query("json_field_extract")
def json_field_extract(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("json_map_explode")
def json_map_explode(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", F.explode(F.from_json("props", "map<string,bigint>"))
                     .alias("key", "value"))


@query("json_array_count")
def json_array_count(spark, sf_dir):
    conv = S.table(spark, sf_dir, "conversations")
    payload = F.to_json(F.split("text", " "))
    return conv.select("conv_id", "turn", F.json_array_length(payload).cast("bigint").alias("n_items"))


@query("request_url")
def request_url(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    secure = F.col("url").startswith("https://")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    base = F.when(secure, F.concat(F.lit("https://"), host)).otherwise(host)
    path = F.regexp_extract("url", r"^https?://[^/?#]+(.*)$", 1)
    return pages.select("page_id", PL.request_url(base, path, secure).alias("request_url"))


@query("request_url_forms")
def request_url_forms(spark, sf_dir):
    """URLs by flag, by base and path, and from a template with encoded values."""
    pages = S.table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    path = F.regexp_extract("url", r"^https?://[^/?#]+(.*)$", 1)
    secure = F.col("url").startswith("https://")
    title = F.regexp_extract("html", r"<title>([^<]*)", 1)
    return pages.select(
        "page_id",
        PL.request_url(F.when(secure, F.concat(F.lit("https://"), host)).otherwise(host), F.concat(F.lit("/v2"), path), secure).alias("flagged"),
        PL.joined_url(F.concat(F.lit("https://"), host), F.concat(F.lit("api"), path)).alias("joined"),
        PL.template_url("https://api.example.com/repos/{owner}/{name}?page=1", owner=host, name=title).alias("templated"))


# ------------------------------------------------------- reshape, quality

def _vendor_events(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("Event Id"), D.as_date("ts").alias("Date"),
                     F.col("value").alias("Adj Close"), F.col("event_type").alias("Event Type"),
                     (F.col("value") * 0).alias("Capital Gains"))


@query("column_normalize")
def column_normalize(spark, sf_dir):
    return RS.normalize_columns(_vendor_events(spark, sf_dir), drop=("capital_gains",),
                                rename={"adj_close": "adjusted_close"})


def _events_with_gaps(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        "event_id",
        F.when(et == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when((et == "click") & (F.col("value") > 50), F.lit(None)).otherwise(F.col("props")).alias("props"),
        F.when(et == "view", F.lit(None)).otherwise(F.col("value")).alias("dividends"))


@query("drop_incomplete")
def drop_incomplete(spark, sf_dir):
    return Q.drop_incomplete(_events_with_gaps(spark, sf_dir), ["value", "props"]).drop("dividends")


@query("default_missing")
def default_missing(spark, sf_dir):
    df = _events_with_gaps(spark, sf_dir).select("event_id", "dividends")
    return Q.default_missing(df, {"dividends": 0.0, "stock_splits": 0.0})


@query("wide_to_long")
def wide_to_long(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").withColumn("day", D.as_date("ts"))
    o = S.event_order()
    wide = (ev.groupBy("day").pivot("event_type")  # the types are read from the table
              .agg(F.min_by("value", o).alias("Open"), F.max("value").alias("High"),
                   F.min("value").alias("Low"), F.max_by("value", o).alias("Close"),
                   F.count(F.lit(1)).alias("Volume")))
    wide = wide.toDF(*[c if c == "day" else c.replace("_", "|", 1) for c in wide.columns])
    long = RS.wide_to_long(wide, index="day")
    return (long.where(F.col("_complete"))
                .select("ticker", "date", "open", "high", "low", "close",
                        F.col("volume").cast("bigint").alias("volume")))


def _landed_wide(spark, sf_dir, name):
    path = scratch_path(spark, name)
    lines = S.wide_lines_from_lineitem(S.table(spark, sf_dir, "lineitem"))
    (lines.repartition("batch").sortWithinPartitions("batch", "n").drop("n")
     .write.partitionBy("batch").text(path))
    return path


@query("wide_file_parse")
def wide_file_parse(spark, sf_dir):
    """Landed wide CSV files with a header of two rows: fields as the headers name
    them, one the engine doesn't know among them."""
    return WIDE.read_wide_csv(spark, _landed_wide(spark, sf_dir, "wide_file_parse"), complete_flag="complete")


@query("wide_file_bars")
def wide_file_bars(spark, sf_dir):
    """Bars from those files."""
    path = _landed_wide(spark, sf_dir, "wide_file_bars")
    bars, _rejected = P.yahoo_quarterly_from_wide(spark, path, fmt="csv2")
    return bars.drop("data_load")


# ------------------------------------------------------------ sinks, stream


_CUST_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("source", T.StringType()), T.StructField("ticker", T.StringType())])


@query("replace_by_ticker")
def replace_by_ticker(spark, sf_dir):
    """Store customers by nation, then restate the nations of region 0; the
    other nations' folders must be untouched."""
    path = scratch_path(spark, "replace_by_ticker")
    cust = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.lit("CUST").alias("source"),
        U.ticker_col("N", "c_nationkey").alias("ticker"), "c_nationkey")
    SK.replace_by_ticker(cust.drop("c_nationkey"), path, order=())
    region0 = S.table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0).select(
        F.col("n_nationkey").alias("c_nationkey"))
    restated = (cust.join(region0, "c_nationkey", "left_semi")
                    .withColumn("c_name", F.concat("c_name", F.lit(" (restated)")))
                    .withColumn("c_acctbal", F.col("c_acctbal") + 1000))
    SK.replace_by_ticker(restated.drop("c_nationkey"), path, order=())
    return SK.read_table(spark, path, _CUST_SCHEMA)


@query("incremental_ingest")
def incremental_ingest(spark, sf_dir):
    """Land fetched payloads in two rounds, the newer ones first, pick each up
    with an availableNow stream, run a third time with nothing new; read the
    published bars. Old fetches that arrive late must change nothing, and a
    ticker whose newest answer is unusable has no bars."""
    base = scratch_path(spark, "ingest")
    landing, bars = f"{base}/landing", f"{base}/bars"
    reg, quar, ckpt = f"{base}/not_available", f"{base}/quarantine", f"{base}/_checkpoint"
    rows = S.order_landing_rows(S.table(spark, sf_dir, "orders"))
    cut = F.lit("1998-01-01").cast("timestamp")
    late = F.coalesce(F.col("fetched_at") < cut, F.lit(False))
    for part in (rows.where(~late), rows.where(late), None):
        if part is not None:
            ING.land(part, landing)
        ING.run_ingest(spark, landing, "AV", bars, reg, quar, ckpt, fmt="parquet",
                       data_load="2024-01-01 00:00:00")
    return SK.read_bucketed(spark, bars).drop("data_load")


@query("read_bucketed_tickers")
def read_bucketed_tickers(spark, sf_dir):
    """Publish the bars of one source, merge those of a second into the table,
    then read the second source's tickers of the first nation's customers."""
    path = scratch_path(spark, "read_bucketed")
    fmp = _fmp_bars(spark, sf_dir)
    SK.replace_in_buckets(fmp, path, n_buckets=16)
    SK.replace_in_buckets(fmp.withColumn("source", F.lit("AV")), path)
    nation0 = S.table(spark, sf_dir, "customer").where("c_nationkey = 0").select(
        U.ticker_col("C", "c_custkey").alias("ticker"))
    return SK.read_bucketed(spark, path, tickers=nation0, source="AV").drop("data_load")


@query("pinned_reader")
def pinned_reader(spark, sf_dir):
    """Customers stored by nation; a reader that came before the nations of region 0
    were restated still sees the old rows, one that comes after the new ones."""
    path = scratch_path(spark, "pinned_reader")
    cust = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.lit("CUST").alias("source"), U.ticker_col("N", "c_nationkey").alias("ticker"))
    nation = S.table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0).select(U.ticker_col("N", "n_nationkey").alias("ticker"))
    SK.replace_in_buckets(cust, path, _CUST_SCHEMA, n_buckets=8, order=("c_custkey",))
    before = SK.read_bucketed(spark, path, _CUST_SCHEMA)
    restated = cust.join(nation, "ticker", "left_semi").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    SK.replace_in_buckets(restated, path, _CUST_SCHEMA, order=("c_custkey",))
    after = SK.read_bucketed(spark, path, _CUST_SCHEMA)
    return before.withColumn("reader", F.lit("before")).unionByName(after.withColumn("reader", F.lit("after")))


@query("stored_order")
def stored_order(spark, sf_dir):
    """Where bars lie in their file: a ticker's together, newest quarter first."""
    path = scratch_path(spark, "stored_order")
    SK.replace_in_buckets(_fmp_bars(spark, sf_dir), path, rows_per_file=1000)
    stored = SK.read_bucketed(spark, path, with_place=True)
    ticker = Window.partitionBy("ticker")  # as many rows as quarters
    return stored.select("ticker", "quarter", (F.col("row_index") - F.min("row_index").over(ticker)).alias("position"),
                         F.size(F.collect_set("file").over(ticker)).cast("bigint").alias("n_files"))


@query("unchanged_refetch")
def unchanged_refetch(spark, sf_dir):
    """All answers are fetched again a year later with the same text: the index
    names the newer fetch, and neither bars nor quarantine get a new version."""
    base = scratch_path(spark, "unchanged_refetch")
    rows = S.order_landing_rows(S.table(spark, sf_dir, "orders"))
    again = rows.withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 365 days"))
    for part in (rows, again):
        ING.land(part, f"{base}/landing")
        ING.run_ingest(spark, f"{base}/landing", "AV", f"{base}/bars", f"{base}/not_available", f"{base}/quarantine",
                       f"{base}/_checkpoint", fmt="parquet", data_load="2024-01-01 00:00:00")
    index = SK.read_bucketed(spark, P.index_path(f"{base}/bars"), SK.INDEX_SCHEMA)
    count = {name: len(SK.versions(spark, f"{base}/{name}")) for name in ("bars", "quarantine")}
    return index.select("ticker", "state", F.date_format("modified", "yyyy-MM-dd").alias("fetched"), "fetch_id",
                        F.lit(count["bars"]).alias("bars_versions"), F.lit(count["quarantine"]).alias("quarantine_versions"))


@query("ticker_from_file_name")
def ticker_from_file_name(spark, sf_dir):
    files = S.order_file_names(S.table(spark, sf_dir, "orders"))
    return files.select("path", SRC.ticker_of_file("path", "AV").alias("ticker"))


@query("ingest_records")
def ingest_records(spark, sf_dir):
    """Where each ticker stands after an ingest in which some answers are
    unusable and older ones arrive late: bars or quarantine, never both."""
    base = scratch_path(spark, "ingest_records")
    landing, bars, man = f"{base}/landing", f"{base}/bars", f"{base}/manifest"
    reg, quar, ckpt = f"{base}/not_available", f"{base}/quarantine", f"{base}/_checkpoint"
    rows = S.order_landing_rows(S.table(spark, sf_dir, "orders"))
    late = F.coalesce(F.col("fetched_at") >= F.lit("1997-01-01").cast("timestamp"), F.lit(True))
    for part in (rows.where(~late), rows.where(late)):
        ING.land(part, landing)
        ING.run_ingest(spark, landing, "AV", bars, reg, quar, ckpt, fmt="parquet",
                       data_load="2024-01-01 00:00:00", manifest_path=man)
    stored = SK.read_bucketed(spark, man, SK.MANIFEST_SCHEMA).withColumn("reason", F.lit(None).cast("string"))
    records = SK.read_bucketed(spark, quar, SK.RECORD_SCHEMA).select("source", "ticker", "reason")
    return (stored.unionByName(records, allowMissingColumns=True)
            .select("source", "ticker", "first_quarter", "last_quarter", "reason"))


@query("repo_summary")
def repo_summary(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    return P.repo_summary(S.page_repo_payloads(pages), S.page_contributor_payloads(pages))


@query("fmp_payload_classify")
def fmp_payload_classify(spark, sf_dir):
    payloads = S.event_fmp_payloads(S.table(spark, sf_dir, "events"))
    return SRC.classify(payloads, "FMP").select("ticker", "status")
