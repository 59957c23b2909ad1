"""Map the driver's tables onto the engine's inputs.

The test tables hold no prices, so each pipeline runs on a stand-in built by
plain projections of a driver table (no sampling, no subsets): its work grows
with the table. The SQL oracles in ``oracle.py`` build the same stand-ins.

daily bars      lineitem: ticker 'S'||l_suppkey, date l_shipdate,
                open l_extendedprice, high price*(1+tax), low price*(1-discount),
                close price*(1-discount)*(1+tax), adjusted close price*(1-discount),
                volume l_quantity, dividend round(l_tax*100), split l_linenumber.
                Rows tie on date, so first/last order by a number that packs the
                date and the row's keys.
FMP daily bars  orders: ticker 'C'||o_custkey, date o_orderdate, price o_totalprice,
                tie-break o_orderkey (unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(high: Column, low: Column) -> Column:
    """Two non-negative longs below 10**18 as one number that orders by both.
    A decimal is a fixed-size aggregate buffer, so ``min_by`` / ``max_by`` on it
    stay in a hash aggregate; on a struct they would sort their input."""
    return high.cast("decimal(18,0)") * F.lit(10 ** 18).cast("decimal(19,0)") + low.cast("decimal(18,0)")


def lineitem_order() -> Column:
    """Deterministic in-quarter order for lineitem stand-in rows: ship date, order,
    line, part, price."""
    day = F.unix_date(as_date("l_shipdate")).cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return packed(day * 10 ** 13 + F.col("l_orderkey") * 10 + F.col("l_linenumber"),
                  F.col("l_partkey") * 10 ** 8 + cents)


def order_order() -> Column:
    """Order of orders: date, then key."""
    return F.unix_date(as_date("o_orderdate")).cast("bigint") * (1 << 40) + F.col("o_orderkey")


def event_order() -> Column:
    """Order of events: time, then id."""
    return packed(F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id"))


def daily_from_lineitem(li: DataFrame) -> DataFrame:
    p, d, t = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        as_date("l_shipdate").alias("date"),
        p.alias("open"),
        (p * (1 + t)).alias("high"),
        (p * (1 - d)).alias("low"),
        (p * (1 - d) * (1 + t)).alias("close"),
        (p * (1 - d)).alias("adjusted_close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.round(t * 100).alias("dividend_amount"),
        F.col("l_linenumber").cast("double").alias("split_coefficient"),
        lineitem_order().alias("_order"),
    )


def daily_from_orders(orders: DataFrame) -> DataFrame:
    p = F.col("o_totalprice")
    return orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
        as_date("o_orderdate").alias("date"),
        p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"),
        p.alias("adjusted_close"),
        F.lit(1).cast("bigint").alias("volume"),
        order_order().alias("_order"),
    )


def yahoo_bars_from_lineitem(li: DataFrame) -> DataFrame:
    """3-month vendor bars (long form) from lineitem: one bar per supplier and
    quarter dated on its first ship date. Open is missing when the first row
    has no discount; the adjusted close is reported as 0.0 when the last row
    has neither tax nor discount (the gate then rejects that supplier).
    Dividends are present, stock splits are not (defaulted to 0.0)."""
    from ..functions.dates import quarter_start
    p, d, t = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    o = lineitem_order()
    first_disc = F.min_by(d, o)
    return (li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
                       quarter_start("l_shipdate").alias("_q"))
              .agg(F.min(as_date("l_shipdate")).alias("date"),
                   F.when(first_disc == 0, F.lit(None).cast("double"))
                    .otherwise(F.min_by(p, o)).alias("open"),
                   F.max(p * (1 + t)).alias("high"),
                   F.min(p * (1 - d)).alias("low"),
                   F.max_by(p * (1 - d) * (1 + t), o).alias("close"),
                   F.when(F.max_by(t + d, o) == 0, F.lit(0.0))
                    .otherwise(F.max_by(p * (1 - d), o)).alias("adj_close"),
                   F.sum("l_quantity").alias("volume"),
                   F.sum(F.round(t * 100)).alias("dividends"))
              .drop("_q"))


#: Fields of the landed wide files, the last one unknown to the engine.
WIDE_FIELDS = ["Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Order Lines"]
#: Files that a fetch of all symbols makes.
WIDE_BATCHES = 7


def wide_lines_from_lineitem(li: DataFrame) -> DataFrame:
    """(batch, n, line): the lines of wide CSV files with a header of two rows, one
    line a quarter. Suppliers are dealt to the files by key; a supplier has all eight fields."""
    from ..functions.dates import quarter_start
    p, d, t, o = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"), lineitem_order()
    bars = li.groupBy("l_suppkey", quarter_start("l_shipdate").alias("day")).agg(
        F.array(*[x.cast("string") for x in (
            F.min_by(p, o), F.max(p * (1 + t)), F.min(p * (1 - d)), F.max_by(p * (1 - d) * (1 + t), o),
            F.max_by(p * (1 - d), o), F.sum(F.col("l_quantity").cast("bigint")), F.sum(F.round(t * 100)), F.count(F.lit(1)))]).alias("cells"))
    batch = F.pmod(F.col("l_suppkey"), F.lit(WIDE_BATCHES)).alias("batch")
    symbols = li.select("l_suppkey", batch).distinct()
    heads = symbols.groupBy("batch").agg(F.sort_array(F.collect_list("l_suppkey")).alias("keys"))
    names = F.array(*map(F.lit, WIDE_FIELDS))
    blank = F.array_repeat(F.lit(""), len(WIDE_FIELDS))

    def header(first, cell):
        return F.concat_ws(",", F.lit(first), F.flatten(F.transform("keys", cell)))
    top = heads.select("batch", F.explode(F.array(
        F.struct(F.lit(0).alias("n"), header("Ticker", lambda k: F.array_repeat(F.concat(F.lit("S"), k.cast("string")), len(WIDE_FIELDS))).alias("line")),
        F.struct(F.lit(1).alias("n"), header("Price", lambda k: names).alias("line")),
        F.struct(F.lit(2).alias("n"), header("Date", lambda k: blank).alias("line")))).alias("x")).select("batch", "x.*")
    held = bars.groupBy(batch, "day").agg(F.map_from_entries(F.collect_list(F.struct("l_suppkey", "cells"))).alias("held"))
    body = held.join(heads, "batch").select("batch", (F.unix_date("day") + 10).alias("n"), F.concat_ws(
        ",", F.col("day").cast("string"), F.flatten(F.transform("keys", lambda k: F.coalesce(F.col("held")[k], blank)))).alias("line"))
    return top.unionByName(body)


def part_symbol() -> Column:
    """Vendor-style symbol per part, covering every cleaning rule: a leading
    digit, an inner digit, '/', '*', the two share-class aliases, plain."""
    size, ptype, name = F.col("p_size"), F.col("p_type"), F.col("p_name")
    return (F.when(size < 8, F.concat(size.cast("string"), F.upper(F.substring(ptype, 1, 2))))
             .when(size < 15, F.concat(F.upper(F.substring(ptype, 1, 3)), size.cast("string")))
             .when(size < 20, F.concat(F.upper(F.substring(ptype, 1, 2)), F.lit("/"),
                                       F.upper(F.substring(name, 1, 1))))
             .when(size < 24, F.concat(F.upper(F.substring(name, 1, 3)), F.lit("*")))
             .when(size < 28, F.lit("BRKB"))
             .when(size < 31, F.lit("BRKA"))
             .otherwise(F.upper(F.replace(name, F.lit(" "), F.lit("")))))


def security_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(prices, cusip->ticker map): lineitem part keys stand for securities
    with prices, part rows map a key to a symbol."""
    prices = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("cusip"))
    mapping = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cusip"),
                                                  part_symbol().alias("ticker"))
    return prices, mapping


# ------------------------------------------------------------- payloads

AV_HEADER = ("timestamp,open,high,low,close,adjusted_close,volume,"
             "dividend_amount,split_coefficient")


def event_payload() -> Column:
    """AV-style response text per event, its kind chosen by the event's own
    fields: purchase -> price CSV (an unreadable date when value < 2, a volume
    beyond 64 bits below 4, a price that is no number below 6, a quoted price
    with a comma below 8, a quoted price below 10),
    error -> rate-limit message (pushed past the head when value >= 50),
    signup -> unknown-ticker error, view -> header only,
    click -> a 5-column CSV (value < 10) or another JSON note."""
    day = F.date_format("ts", "yyyy-MM-dd")
    v = F.col("value").cast("string")
    user = F.col("user_id").cast("string")
    x = F.col("value")
    first = (F.when((x >= 4) & (x < 6), F.lit("abc")).when((x >= 6) & (x < 8), F.lit('"1,234"'))
              .when((x >= 8) & (x < 10), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v))
    price_line = F.concat_ws(",", F.when(x < 2, F.lit("bad-date")).otherwise(day), first, v, v, v, v,
                             F.when((x >= 2) & (x < 4), F.lit("9" * 20)).otherwise(user),
                             F.lit("0.0"), F.lit("1.0"))
    et = F.col("event_type")
    return (F.when(et == "purchase", F.concat(F.lit(AV_HEADER + "\n"), price_line, F.lit("\n")))
             .when(et == "error",
                   F.when(F.col("value") < 50,
                          F.lit('{"message": "You have exceeded the rate limit per minute for your plan"}'))
                    .otherwise(F.concat(F.lit('{"message": "'), F.lit("z" * 100),
                                        F.lit(' exceeded the rate limit per minute"}'))))
             .when(et == "signup", F.concat(F.lit('{\n    "Error Message": "Invalid API call for user '),
                                            user, F.lit('"\n}\n')))
             .when(et == "view", F.lit(AV_HEADER + "\n"))
             .otherwise(F.when(F.col("value") < 10,
                               F.concat(F.lit("timestamp,open,high,low,close\n"), day, F.lit(",1,2,0.5,1.5\n")))
                         .otherwise(F.concat(F.lit('{\n    "Note": "hello '), user, F.lit('"\n}\n')))))


def event_payloads(events: DataFrame) -> DataFrame:
    """(source, ticker, path, modified, payload): one AV payload per event."""
    return events.select(F.lit("AV").alias("source"),
                         F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("ticker"),
                         F.lit(None).cast("string").alias("path"),
                         F.col("ts").cast("timestamp").alias("modified"),
                         event_payload().alias("payload"))


def order_csv_text() -> Column:
    """AV CSV payload text of an order: two daily lines, newest first (the
    order date and the day before, same price; volume = customer key)."""
    p = F.col("o_totalprice").cast("string")
    vol = F.col("o_custkey").cast("string")

    def line(day):
        # the price is written once and repeated: a double's text is the dearest part of a row
        return F.concat_ws(",", F.date_format(day, "yyyy-MM-dd"), F.array_repeat(p, 5), vol,
                           F.lit("0.0"), F.lit("1.0"))
    d = as_date("o_orderdate")
    return F.concat(F.lit(AV_HEADER + "\n"), line(d), F.lit("\n"), line(F.date_sub(d, 1)), F.lit("\n"))


def _order_payloads(orders: DataFrame, text: Column) -> DataFrame:
    return orders.select(F.lit("AV").alias("source"),
                         F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("ticker"),
                         F.lit(None).cast("string").alias("path"),
                         F.col("o_orderdate").cast("timestamp").alias("modified"),
                         text.alias("payload"))


def order_csv_payloads(orders: DataFrame) -> DataFrame:
    """One AV CSV payload per order (ticker 'O'||o_orderkey)."""
    return _order_payloads(orders, order_csv_text())


def order_quoted_payloads(orders: DataFrame) -> DataFrame:
    """The same with a quoted header cell and, before the prices, a quoted note
    that holds a comma, doubled quotes and a line break."""
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""order""\n'), F.col("o_orderkey").cast("string"), F.lit('"'))
    p, vol = F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")

    def line(day):
        return F.concat_ws(",", note, F.date_format(day, "yyyy-MM-dd"), p, p, p, p, F.concat(F.lit('"'), p, F.lit('"')),
                           vol, F.lit("0.0"), F.lit("1.0"))
    d = as_date("o_orderdate")
    header = F.lit('"note",' + AV_HEADER + "\r\n")
    return _order_payloads(orders, F.concat(header, line(d), F.lit("\r\n"), line(F.date_sub(d, 1)), F.lit("\n")))


def order_volume_payloads(orders: DataFrame) -> DataFrame:
    """Payloads of two rows of one day whose volumes sum to 2**63 - 1 for even
    orders (the most a 64-bit integer holds) and to one more for odd ones."""
    key = F.col("o_orderkey")
    first = F.lit(2 ** 63 - 1) - F.col("o_custkey")
    second = F.col("o_custkey") + key % 2
    day = F.date_format(as_date("o_orderdate"), "yyyy-MM-dd")
    lines = [F.concat_ws(",", day, *[F.lit("1.5")] * 5, v.cast("string"), F.lit("0.0"), F.lit("1.0")) for v in (first, second)]
    return _order_payloads(orders, F.concat(F.lit(AV_HEADER + "\n"), lines[0], F.lit("\n"), lines[1], F.lit("\n")))


def order_json_payloads(orders: DataFrame) -> DataFrame:
    """One FMP JSON payload per order with one history record."""
    rec = F.struct(F.date_format(as_date("o_orderdate"), "yyyy-MM-dd").alias("date"),
                   F.col("o_totalprice").alias("open"), F.col("o_totalprice").alias("high"),
                   F.col("o_totalprice").alias("low"), F.col("o_totalprice").alias("close"),
                   F.col("o_totalprice").alias("adjClose"), F.col("o_custkey").alias("volume"))
    sym = F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))
    text = F.to_json(F.struct(sym.alias("symbol"), F.array(rec).alias("historical")))
    return orders.select(F.lit("FMP").alias("source"), sym.alias("ticker"),
                         F.lit(None).cast("string").alias("path"),
                         F.col("o_orderdate").cast("timestamp").alias("modified"),
                         text.alias("payload"))


def customer_json_payloads(orders: DataFrame) -> DataFrame:
    """One FMP JSON payload per customer with a record for each of its orders, newest first."""
    p = F.col("o_totalprice")
    rec = F.struct(F.date_format(as_date("o_orderdate"), "yyyy-MM-dd").alias("date"), p.alias("open"), (p + 1).alias("high"),
                   (p - 1).alias("low"), p.alias("close"), (p / 2).alias("adjClose"), F.col("o_orderkey").alias("volume"))
    sym = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    listed = orders.groupBy(sym.alias("ticker")).agg(
        F.sort_array(F.collect_list(F.struct(order_order().alias("k"), rec.alias("r"))), asc=False).alias("rs"))
    text = F.to_json(F.struct(F.col("ticker").alias("symbol"), F.transform("rs", lambda x: x["r"]).alias("historical")))
    return listed.select(F.lit("FMP").alias("source"), "ticker", F.lit(None).cast("string").alias("path"),
                         F.lit(None).cast("timestamp").alias("modified"), text.alias("payload"))


def order_landing_rows(orders: DataFrame) -> DataFrame:
    """Fetched payload rows for the stream: each order is one fetch of its
    customer's ticker (fetch time = order date, fetch id = order key), so a
    customer is fetched many times and the newest fetch must win. The answer
    to an urgent order is a header without rows (unusable)."""
    return orders.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
                         F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
                         F.col("o_orderkey").alias("fetch_id"),
                         F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(AV_HEADER + "\n"))
                          .otherwise(order_csv_text()).alias("payload"))


def order_answers(orders: DataFrame) -> DataFrame:
    """AV payload rows like ``order_landing_rows``, in which the answer to a low
    order is that the ticker is unknown."""
    unknown = '{\n    "Error Message": "Invalid API call."\n}\n'
    return orders.select(F.lit("AV").alias("source"),
                         F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
                         F.lit(None).cast("string").alias("path"),
                         F.col("o_orderdate").cast("timestamp").alias("modified"),
                         F.col("o_orderkey").alias("fetch_id"),
                         F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(AV_HEADER + "\n"))
                          .when(F.col("o_orderpriority") == "5-LOW", F.lit(unknown))
                          .otherwise(order_csv_text()).alias("payload"))


def order_file_names(orders: DataFrame) -> DataFrame:
    """The path of each order's payload, in the forms a landing folder holds:
    without and with the vendor's tag, numbered, and URL-encoded."""
    key = F.concat(F.lit("O"), F.col("o_orderkey").cast("string"))
    name = (F.when(F.col("o_orderkey") % 5 == 0, F.concat(key, F.lit(".csv")))
             .when(F.col("o_orderkey") % 5 == 1, F.concat(key, F.lit("_AV.csv")))
             .when(F.col("o_orderkey") % 5 == 2, F.concat(key, F.lit("_AV_2.csv")))
             .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("%5E"), key, F.lit("_AV_1997.csv")))
             .otherwise(F.concat(key, F.lit("_B+x_AV.json"))))
    return orders.select("o_orderkey", F.concat(F.lit("file:/landing/av_AV/"), name).alias("path"),
                         F.col("o_orderdate").cast("timestamp").alias("modified"), order_csv_text().alias("payload"))


def _contributors_url() -> Column:
    return F.concat(F.col("url"), F.lit("#contributors-"), F.col("page_id").cast("string"))


def page_repo_payloads(pages: DataFrame) -> DataFrame:
    """One repository JSON per page: stars = page id, plus the URL of its
    contributor list."""
    return pages.select(F.to_json(F.struct(F.col("page_id").alias("stargazers_count"),
                                           _contributors_url().alias("contributors_url")))
                        .alias("payload"))


def page_contributor_payloads(pages: DataFrame) -> DataFrame:
    """The contributor list behind each repository URL: a JSON array with one
    element per '<'-separated piece of the page's html (whole text)."""
    return pages.select(_contributors_url().alias("url"),
                        F.to_json(F.split("html", "<")).alias("payload"))


def event_fmp_payload() -> Column:
    """FMP-style response text per event: purchase -> a one-record history,
    signup -> '{}' (unknown symbol), error -> the plan-limit message,
    view -> an object without history, click -> '[]' (value < 10) or a
    history whose volume is beyond the 64-bit range."""
    day = F.date_format("ts", "yyyy-MM-dd")
    v = F.col("value").cast("string")
    user = F.col("user_id").cast("string")

    def history(volume):
        return F.concat(F.lit('{"symbol": "U'), user, F.lit('", "historical": [{"date": "'), day,
                        F.lit('", "open": '), v, F.lit(', "high": '), v, F.lit(', "low": '), v,
                        F.lit(', "close": '), v, F.lit(', "adjClose": '), v,
                        F.lit(', "volume": '), volume, F.lit("}]}"))
    et = F.col("event_type")
    return (F.when(et == "purchase", history(user))
             .when(et == "signup", F.lit("{}"))
             .when(et == "error", F.lit('{"Error Message": "Limit Reach . Please upgrade your plan"}'))
             .when(et == "view", F.concat(F.lit('{"note": "x'), user, F.lit('"}')))
             .otherwise(F.when(F.col("value") < 10, F.lit("[]"))
                         .otherwise(history(F.lit("99999999999999999999999999")))))


def event_fmp_payloads(events: DataFrame) -> DataFrame:
    """(source, ticker, path, modified, payload): one FMP payload per event."""
    return events.select(F.lit("FMP").alias("source"),
                                  F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("ticker"),
                                  F.lit(None).cast("string").alias("path"),
                                  F.col("ts").cast("timestamp").alias("modified"),
                                  event_fmp_payload().alias("payload"))
