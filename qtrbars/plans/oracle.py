"""Independent SQL oracles (DuckDB dialect) for the driver queries.

Each string recomputes a query of ``queries.py`` from the raw driver tables
(views ``lineitem``, ``orders``, ``events``, ...) without sharing any code with
the Spark side. Column names and types match the Spark result.
"""

from __future__ import annotations

# Stand-in daily bars from lineitem (see standins.py).
_DAILY_LINEITEM = """
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker,
         CAST(l_shipdate AS DATE) AS d,
         l_extendedprice AS open,
         l_extendedprice * (1 + l_tax) AS high,
         l_extendedprice * (1 - l_discount) AS low,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS close,
         l_extendedprice * (1 - l_discount) AS adjusted_close,
         CAST(l_quantity AS BIGINT) AS volume,
         round(l_tax * 100) AS dividend_amount,
         CAST(l_linenumber AS DOUBLE) AS split_coefficient,
         (CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey,
          l_extendedprice, l_discount, l_tax) AS ord
  FROM lineitem
"""

_DAILY_ORDERS = """
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker,
         CAST(o_orderdate AS DATE) AS d,
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low,
         o_totalprice AS close, o_totalprice AS adjusted_close,
         CAST(1 AS BIGINT) AS volume,
         (CAST(o_orderdate AS DATE), o_orderkey) AS ord
  FROM orders
"""


def _label(d: str) -> str:
    return f"CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR)"


def _qend(d: str) -> str:
    return f"last_day(CAST(date_trunc('quarter', {d}) AS DATE) + INTERVAL 2 MONTH)"


def _bars_cte(daily: str, actions: bool) -> str:
    act_aggs = """,
         coalesce(sum(dividend_amount), 0.0) AS dividend_amount,
         coalesce(min(CASE WHEN split_coefficient <> 1 THEN split_coefficient END), 1.0)
           AS split_coefficient""" if actions else """,
         CAST(NULL AS DOUBLE) AS dividend_amount,
         CAST(NULL AS DOUBLE) AS split_coefficient"""
    return f"""
daily AS ({daily}),
bars AS (
  SELECT ticker, CAST(date_trunc('quarter', d) AS DATE) AS qs,
         arg_min(open, ord) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, ord) AS close, arg_max(adjusted_close, ord) AS adjusted_close,
         CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume{act_aggs}
  FROM daily GROUP BY ticker, CAST(date_trunc('quarter', d) AS DATE))"""


def _bars_sql(daily: str, source: str, actions: bool) -> str:
    return f"""
WITH {_bars_cte(daily, actions)},
filled AS (
  SELECT *, last_value(adjusted_close IGNORE NULLS) OVER (
              PARTITION BY ticker ORDER BY qs
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f,
            first_value(adjusted_close) OVER (
              PARTITION BY ticker ORDER BY qs
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base
  FROM bars),
prev AS (
  SELECT *, lag(f) OVER (PARTITION BY ticker ORDER BY qs) AS pf FROM filled)
SELECT '{source}' AS source, ticker, {_label('qs')} AS "quarter",
       open, high, low, close, adjusted_close, volume, dividend_amount, split_coefficient,
       last_day(qs + INTERVAL 2 MONTH) AS "date",
       round((f - pf) / NULLIF(pf, 0) * 100, 2) + 0.0 AS pct_change,
       round((adjusted_close - base) / NULLIF(base, 0) * 100, 2) + 0.0 AS compound_return
FROM prev
"""


_LI_ORD = """(CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_partkey,
               l_extendedprice, l_discount, l_tax)"""

_YAHOO = f"""
WITH li AS (SELECT *, {_LI_ORD} AS ord FROM lineitem),
long AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker,
         min(CAST(l_shipdate AS DATE)) AS bd,
         CASE WHEN arg_min(l_discount, ord) = 0 THEN NULL
              ELSE arg_min(l_extendedprice, ord) END AS open,
         max(l_extendedprice * (1 + l_tax)) AS high,
         min(l_extendedprice * (1 - l_discount)) AS low,
         arg_max(l_extendedprice * (1 - l_discount) * (1 + l_tax), ord) AS close,
         CASE WHEN arg_max(l_tax + l_discount, ord) = 0 THEN 0.0
              ELSE arg_max(l_extendedprice * (1 - l_discount), ord) END AS adj_close,
         sum(l_quantity) AS volume,
         sum(round(l_tax * 100)) AS dividends
  FROM li GROUP BY l_suppkey, date_trunc('quarter', l_shipdate)),
complete AS (
  SELECT * FROM long
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND adj_close IS NOT NULL AND volume IS NOT NULL AND dividends IS NOT NULL),
kept AS (
  SELECT * FROM complete c
  WHERE NOT EXISTS (SELECT 1 FROM complete z WHERE z.ticker = c.ticker AND z.adj_close <= 0)),
w AS (
  SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY bd) AS prev,
         first_value(adj_close) OVER (PARTITION BY ticker ORDER BY bd
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base
  FROM kept)
SELECT 'YAHOO' AS source, ticker, {_label('bd')} AS "quarter",
       open, high, low, close, adj_close AS adjusted_close,
       CAST(trunc(volume) AS BIGINT) AS volume,
       dividends AS dividend_amount, CAST(0.0 AS DOUBLE) AS split_coefficient,
       CASE WHEN bd = {_qend('bd')} THEN last_day({_qend('bd')} + INTERVAL 3 MONTH)
            ELSE {_qend('bd')} END AS "date",
       round((adj_close / NULLIF(prev, 0) - 1) * 100, 2) + 0.0 AS pct_change,
       round((adj_close - base) / NULLIF(base, 0) * 100, 2) + 0.0 AS compound_return
FROM w
"""

_SYMBOL = """CASE WHEN p_size < 8 THEN CAST(p_size AS VARCHAR) || upper(substr(p_type, 1, 2))
            WHEN p_size < 15 THEN upper(substr(p_type, 1, 3)) || CAST(p_size AS VARCHAR)
            WHEN p_size < 20 THEN upper(substr(p_type, 1, 2)) || '/' || upper(substr(p_name, 1, 1))
            WHEN p_size < 24 THEN upper(substr(p_name, 1, 3)) || '*'
            WHEN p_size < 28 THEN 'BRKB'
            WHEN p_size < 31 THEN 'BRKA'
            ELSE upper(replace(p_name, ' ', '')) END"""

_UNIVERSE = f"""
  SELECT m.ticker
  FROM (SELECT DISTINCT l_partkey AS cusip FROM lineitem) p
  JOIN (SELECT DISTINCT p_partkey AS cusip, {_SYMBOL} AS ticker FROM part) m
    ON p.cusip = m.cusip
"""

_REMAP = "CASE ticker WHEN 'BRKB' THEN 'BRK-B' WHEN 'BRKA' THEN 'BRK-A' ELSE ticker END"
_STRICT = "NOT regexp_matches(ticker, '[0-9]') AND NOT regexp_matches(ticker, '[/*]')"
_LEADING = "NOT regexp_matches(ticker, '^[0-9]') AND NOT regexp_matches(ticker, '[/*]')"
_NORMAL = f"SELECT {_REMAP} AS ticker FROM ({_UNIVERSE}) u WHERE {_STRICT}"
_KEPT = f"SELECT ticker FROM ({_UNIVERSE}) u WHERE {_STRICT}"

_FMP_BARS = _bars_sql(_DAILY_ORDERS, "FMP", False)
_AV_BARS = _bars_sql(_DAILY_LINEITEM, "AV", True)
_ORDER_DATES = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"

ORACLES: dict[str, str] = {
    "quarterly_bars_av": _AV_BARS,
    "quarterly_bars_fmp": _FMP_BARS,
    "quarterly_bars_yahoo": _YAHOO,
    "ticker_universe": _UNIVERSE,
    "ticker_normalize": _NORMAL,
    "ticker_normalize_leading": f"SELECT {_REMAP} AS ticker FROM ({_UNIVERSE}) u WHERE {_LEADING}",
    "distinct_tickers": f"SELECT DISTINCT ticker FROM ({_NORMAL}) n",
    "ticker_sample": f"""SELECT ticker FROM (SELECT DISTINCT ticker FROM ({_NORMAL}) n) d
                          ORDER BY md5('42-' || ticker), ticker LIMIT 30""",
    "batch_round_robin": f"""SELECT {_REMAP} AS ticker,
                               CAST((row_number() OVER (ORDER BY ticker) - 1) % 7 AS INTEGER) AS batch
                             FROM ({_KEPT}) k""",
    "universe_offset": f"SELECT {_REMAP} AS ticker FROM ({_KEPT}) k ORDER BY ticker OFFSET 100",
    "pending_tickers": """
        SELECT ticker FROM (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker FROM customer
                            UNION SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier) u
        WHERE ticker NOT IN (SELECT 'C' || CAST(o_custkey AS VARCHAR) FROM orders)""",
    "trading_span": f"""
        SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker,
               min({_label('o_orderdate')}) AS first_quarter,
               max({_label('o_orderdate')}) AS last_quarter
        FROM orders GROUP BY o_custkey""",
    "latest_quarters": f"""
        SELECT ticker, "quarter", adjusted_close, pct_change, compound_return
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY "date" DESC) AS rn
              FROM ({_FMP_BARS}) b) r
        WHERE rn = 1""",
    "price_gate": """
        SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer c
        WHERE EXISTS (SELECT 1 FROM (SELECT c_nationkey, c_mktsegment FROM customer
                                     GROUP BY c_nationkey, c_mktsegment
                                     HAVING coalesce(bool_and(c_acctbal > 0), true)) g
                      WHERE g.c_nationkey = c.c_nationkey AND g.c_mktsegment = c.c_mktsegment)""",
    "any_all": """
        SELECT user_id,
               coalesce(bool_or(event_type = 'error'), false) AS any_error,
               coalesce(bool_or(contains(props, '"k": 9')), false) AS any_k9,
               coalesce(bool_and(value > 0), true) AS all_positive,
               coalesce(bool_and(value > 1), true) AS all_over_one
        FROM events GROUP BY user_id""",
    "quarter_end_date": f"SELECT d, {_qend('d')} AS quarter_end FROM ({_ORDER_DATES}) x",
    "quarter_label": f"SELECT d, {_label('d')} AS \"quarter\" FROM ({_ORDER_DATES}) x",
    "quarter_end_offset": f"""
        SELECT d, CASE WHEN d = {_qend('d')} THEN last_day({_qend('d')} + INTERVAL 3 MONTH)
                       ELSE {_qend('d')} END AS offset_end
        FROM ({_ORDER_DATES}) x""",
    "split_coefficient": f"""
        SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker, {_label('l_shipdate')} AS "quarter",
               coalesce(min(CASE WHEN s <> 1 THEN s END), 1.0) AS split_coefficient
        FROM (SELECT *, CASE WHEN l_quantity > 45 THEN l_quantity / 10 ELSE 1.0 END AS s
              FROM lineitem) x
        GROUP BY 1, 2""",
    "pct_change": f'SELECT ticker, "quarter", pct_change FROM ({_AV_BARS}) b',
    "pct_change_desc": f"""
        WITH {_bars_cte(_DAILY_LINEITEM, True)}
        SELECT ticker, {_label('qs')} AS "quarter",
               round((adjusted_close / NULLIF(lead(adjusted_close) OVER (
                        PARTITION BY ticker ORDER BY qs DESC), 0) - 1) * 100, 2) + 0.0 AS pct_change
        FROM bars""",
    "compound_return": f'SELECT ticker, "quarter", compound_return FROM ({_AV_BARS}) b',
}


# ---------------------------------------------------------------- payloads

_HDR = ("timestamp,open,high,low,close,adjusted_close,volume,"
        "dividend_amount,split_coefficient")
_NL = "chr(10)"

_EVENT_PAYLOADS = f"""
  SELECT 'E' || CAST(event_id AS VARCHAR) AS ticker,
    CASE event_type
      WHEN 'purchase' THEN '{_HDR}' || {_NL}
           || concat_ws(',', CASE WHEN value < 2 THEN 'bad-date' ELSE strftime(ts, '%Y-%m-%d') END,
                        CASE WHEN value >= 4 AND value < 6 THEN 'abc'
                             WHEN value >= 6 AND value < 8 THEN '"1,234"'
                             WHEN value >= 8 AND value < 10 THEN '"' || CAST(value AS VARCHAR) || '"'
                             ELSE CAST(value AS VARCHAR) END,
                        CAST(value AS VARCHAR), CAST(value AS VARCHAR),
                        CAST(value AS VARCHAR), CAST(value AS VARCHAR),
                        CASE WHEN value >= 2 AND value < 4 THEN repeat('9', 20) ELSE CAST(user_id AS VARCHAR) END,
                        '0.0', '1.0') || {_NL}
      WHEN 'error' THEN CASE WHEN value < 50
           THEN '{{"message": "You have exceeded the rate limit per minute for your plan"}}'
           ELSE '{{"message": "' || repeat('z', 100) || ' exceeded the rate limit per minute"}}' END
      WHEN 'signup' THEN '{{' || {_NL} || '    "Error Message": "Invalid API call for user '
           || CAST(user_id AS VARCHAR) || '"' || {_NL} || '}}' || {_NL}
      WHEN 'view' THEN '{_HDR}' || {_NL}
      ELSE CASE WHEN value < 10
           THEN 'timestamp,open,high,low,close' || {_NL} || strftime(ts, '%Y-%m-%d') || ',1,2,0.5,1.5' || {_NL}
           ELSE '{{' || {_NL} || '    "Note": "hello ' || CAST(user_id AS VARCHAR) || '"' || {_NL} || '}}' || {_NL} END
    END AS payload
  FROM events
"""

_CLASSIFIED = f"""
  WITH p AS ({_EVENT_PAYLOADS}),
  x AS (SELECT ticker, payload, string_split_regex(payload, '\\r?\\n') AS ls FROM p),
  y AS (SELECT ticker, payload,
               list_filter(ls[2:], lambda l: trim(l) <> '') AS body,
               list_transform(string_split(ls[1], ','), lambda f: trim(f)) AS hdr
        FROM x)
  SELECT ticker, payload, CASE
    WHEN regexp_matches(substr(payload, 1, 100),
         'exceeded the DAILY quota|exceeded the rate limit per minute|not subscribed to this API')
      THEN 'rate_limited'
    WHEN len(body) >= 1 AND len(hdr) >= 8 THEN
      CASE WHEN list_bool_or(list_transform(body, lambda l: try_strptime(
                 trim(string_split(l, ',')[list_position(hdr, 'timestamp')]), '%Y-%m-%d') IS NULL
                 OR len(list_filter(string_split(regexp_replace(l, '"([^",]*)"', '\\1', 'g'), ',')[2:],
                                    lambda c: TRY_CAST(c AS DOUBLE) IS NULL)) > 0
                 OR TRY_CAST(string_split(regexp_replace(l, '"([^",]*)"', '\\1', 'g'), ',')[7] AS HUGEINT)
                    >= 9223372036854775807))
           THEN 'unparseable' ELSE 'ok' END
    WHEN len(body) >= 1 AND list_contains(hdr, '{{')
         AND list_bool_or(list_transform(body, lambda l: contains(l, 'Invalid API call')))
      THEN 'not_available'
    ELSE 'unrecognized' END AS status
  FROM y
"""


def _order_rows(shift_days: int, source: str, with_actions: bool) -> str:
    acts = (", CAST(0.0 AS DOUBLE) AS dividend_amount, CAST(1.0 AS DOUBLE) AS split_coefficient"
            if with_actions else "")
    return f"""
  SELECT '{source}' AS source, 'O' || CAST(o_orderkey AS VARCHAR) AS ticker,
         CAST(o_orderdate AS DATE) - {shift_days} AS "date",
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low,
         o_totalprice AS close, o_totalprice AS adjusted_close,
         CAST(o_custkey AS BIGINT) AS volume{acts}
  FROM orders"""


ORACLES.update({
    "payload_classify": f"SELECT ticker, status FROM ({_CLASSIFIED}) c",
    "payload_quarantine": f"""
        SELECT 'AV' AS source, ticker, status AS reason, payload FROM ({_CLASSIFIED}) c
        WHERE status IN ('unparseable', 'unrecognized')""",
    "not_available_registry": f"""
        SELECT 'AV' AS source, ticker, status AS reason, payload FROM ({_CLASSIFIED}) c
        WHERE status = 'not_available'""",
    "csv_payload_parse": _order_rows(0, "AV", True) + "\n  UNION ALL" + _order_rows(1, "AV", True),
    "csv_quoted_records": _order_rows(0, "AV", True) + "\n  UNION ALL" + _order_rows(1, "AV", True),
    "volume_limit": """
        SELECT ticker, CASE WHEN total > 9223372036854775807 THEN 'unparseable' ELSE 'ok' END AS status,
               CAST(TRY_CAST(total AS BIGINT) AS VARCHAR) AS volume
        FROM (SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS ticker,
                     CAST(9223372036854775807 - o_custkey AS HUGEINT) + o_custkey + o_orderkey % 2 AS total
              FROM orders) t""",
    "json_records_explode": _order_rows(0, "FMP", False),
    "json_field_extract": """
        SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "json_map_explode": """
        SELECT event_id, k AS "key",
               TRY_CAST(json_extract_string(props, '$."' || k || '"') AS BIGINT) AS "value"
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) t""",
    "json_array_count": """
        SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_items
        FROM conversations""",
    "request_url": "SELECT page_id, url AS request_url FROM pages",
    "column_normalize": """
        SELECT event_id, CAST(ts AS DATE) AS "date", value AS adjusted_close, event_type
        FROM events""",
    "drop_incomplete": """
        SELECT event_id, value, props FROM (
          SELECT event_id,
                 CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
                 CASE WHEN event_type = 'click' AND value > 50 THEN NULL ELSE props END AS props
          FROM events) t
        WHERE value IS NOT NULL AND props IS NOT NULL""",
    "default_missing": """
        SELECT event_id,
               coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE value END, CAST(0.0 AS DOUBLE))
                 AS dividends,
               CAST(0.0 AS DOUBLE) AS stock_splits
        FROM events""",
    "wide_to_long": """
        SELECT event_type AS ticker, CAST(ts AS DATE) AS "date",
               arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS BIGINT) AS volume
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
})


_NEWEST_ORDER_DAILY = """
  SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS ticker,
         CAST(o.o_orderdate AS DATE) - t.k AS d,
         o.o_totalprice AS open, o.o_totalprice AS high, o.o_totalprice AS low,
         o.o_totalprice AS close, o.o_totalprice AS adjusted_close,
         CAST(o.o_custkey AS BIGINT) AS volume,
         CAST(0.0 AS DOUBLE) AS dividend_amount, CAST(1.0 AS DOUBLE) AS split_coefficient,
         CAST(o.o_orderdate AS DATE) - t.k AS ord
  FROM orders o
  JOIN (SELECT arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest
        FROM orders GROUP BY o_custkey) n ON o.o_orderkey = n.newest
  CROSS JOIN (VALUES (0), (1)) t(k)
  WHERE o.o_orderpriority <> '1-URGENT'
"""

ORACLES.update({
    "replace_by_ticker": """
        SELECT c_custkey,
               CASE WHEN r THEN c_name || ' (restated)' ELSE c_name END AS c_name,
               CASE WHEN r THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal,
               'CUST' AS source, 'N' || CAST(c_nationkey AS VARCHAR) AS ticker
        FROM (SELECT c.*, c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0) AS r
              FROM customer c) x""",
    "incremental_ingest": _bars_sql(_NEWEST_ORDER_DAILY, "AV", True),
})

ORACLES["read_bucketed_tickers"] = f"""
    SELECT b.* REPLACE ('AV' AS source) FROM ({_bars_sql(_DAILY_ORDERS, "FMP", False)}) b
    WHERE b.ticker IN (SELECT 'C' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 0)"""

ORACLES["ingest_records"] = f"""
    SELECT 'AV' AS source, ticker, min({_label('d')}) AS first_quarter, max({_label('d')}) AS last_quarter,
           CAST(NULL AS VARCHAR) AS reason
    FROM ({_NEWEST_ORDER_DAILY}) x GROUP BY ticker
    UNION ALL
    SELECT 'AV', 'C' || CAST(o_custkey AS VARCHAR), NULL, NULL, 'unrecognized'
    FROM orders GROUP BY o_custkey
    HAVING arg_max(o_orderpriority, (o_orderdate, o_orderkey)) = '1-URGENT'"""


ORACLES["repo_summary"] = """
    SELECT url || '#contributors-' || CAST(page_id AS VARCHAR) AS contributors_url,
           page_id AS stargazers_count,
           CAST(len(string_split(html, '<')) AS BIGINT) AS contributors
    FROM pages"""


_FMP_HIST = """'{{"symbol": "U' || CAST(user_id AS VARCHAR) || '", "historical": [{{"date": "'
       || strftime(ts, '%Y-%m-%d') || '", "open": ' || CAST(value AS VARCHAR)
       || ', "high": ' || CAST(value AS VARCHAR) || ', "low": ' || CAST(value AS VARCHAR)
       || ', "close": ' || CAST(value AS VARCHAR) || ', "adjClose": ' || CAST(value AS VARCHAR)
       || ', "volume": ' || {vol} || '}}]}}'"""

ORACLES["fmp_payload_classify"] = f"""
  WITH p AS (
    SELECT 'E' || CAST(event_id AS VARCHAR) AS ticker,
      CASE event_type
        WHEN 'purchase' THEN {_FMP_HIST.format(vol="CAST(user_id AS VARCHAR)")}
        WHEN 'signup' THEN '{{}}'
        WHEN 'error' THEN '{{"Error Message": "Limit Reach . Please upgrade your plan"}}'
        WHEN 'view' THEN '{{"note": "x' || CAST(user_id AS VARCHAR) || '"}}'
        ELSE CASE WHEN value < 10 THEN '[]'
                  ELSE {_FMP_HIST.format(vol="'99999999999999999999999999'")} END
      END AS payload
    FROM events)
  SELECT ticker, CASE
    WHEN regexp_matches(substr(payload, 1, 100),
         'exceeded the DAILY quota|exceeded the rate limit per minute|not subscribed to this API|Limit Reach')
      THEN 'rate_limited'
    WHEN NOT json_valid(payload) OR json_type(payload) NOT IN ('OBJECT', 'ARRAY') THEN 'unparseable'
    WHEN (json_type(payload) = 'OBJECT' AND len(json_keys(payload)) = 0)
      OR (json_type(payload) = 'ARRAY' AND json_array_length(payload) = 0) THEN 'not_available'
    WHEN coalesce(json_type(payload, '$.historical'), '') <> 'ARRAY'
      OR json_array_length(payload, '$.historical') = 0 THEN 'unrecognized'
    WHEN list_bool_or(list_transform(CAST(json_extract(payload, '$.historical[*]') AS JSON[]),
           lambda r: try_strptime(json_extract_string(r, '$.date'), '%Y-%m-%d') IS NULL
                     OR abs(TRY_CAST(json_extract_string(r, '$.volume') AS DOUBLE)) >= 9.223372036854775807e18))
      THEN 'unparseable'
    ELSE 'ok' END AS status
  FROM p"""


# ------------------------------------------------------------ stored state

_NEWEST_ANSWER = """SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
                    max(o_orderdate) AS fetched, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS fetch_id
                    FROM orders GROUP BY o_custkey"""

ORACLES.update({
    "pending_work": f"""
        SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker
        FROM (SELECT DISTINCT c_custkey FROM customer) c LEFT JOIN ({_NEWEST_ANSWER}) n ON n.o_custkey = c.c_custkey
        WHERE n.priority IS NULL OR n.priority = '1-URGENT'""",
    "not_available_sink": f"""
        SELECT 'AV' AS source, 'C' || CAST(o_custkey AS VARCHAR) AS ticker, 'not_available' AS reason,
               '{{' || chr(10) || '    "Error Message": "Invalid API call."' || chr(10) || '}}' || chr(10) AS payload,
               '2024-01-01 00:00:00' AS data_load
        FROM ({_NEWEST_ANSWER}) n WHERE priority = '5-LOW'""",
    "pinned_reader": """
        SELECT c_custkey, c_name, c_acctbal + CASE WHEN reader = 'after' AND r THEN 1000 ELSE 0 END AS c_acctbal,
               'CUST' AS source, 'N' || CAST(c_nationkey AS VARCHAR) AS ticker, reader
        FROM (SELECT c.*, c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0) AS r FROM customer c) x,
             (VALUES ('before'), ('after')) v(reader)""",
    "stored_order": f"""
        SELECT ticker, "quarter", row_number() OVER (PARTITION BY ticker ORDER BY "quarter" DESC) - 1 AS position,
               CAST(1 AS BIGINT) AS n_files
        FROM (SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, {_label('o_orderdate')} AS "quarter"
              FROM orders) q""",
    "unchanged_refetch": f"""
        SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker,
               CASE WHEN priority = '1-URGENT' THEN 'quarantine' ELSE 'bars' END AS state,
               strftime(fetched + INTERVAL 365 DAY, '%Y-%m-%d') AS fetched, fetch_id,
               1 AS bars_versions, 1 AS quarantine_versions
        FROM ({_NEWEST_ANSWER}) n""",
    "ticker_from_file_name": """
        SELECT 'file:/landing/av_AV/' || CASE o_orderkey % 5 WHEN 0 THEN o || '.csv' WHEN 1 THEN o || '_AV.csv'
                 WHEN 2 THEN o || '_AV_2.csv' WHEN 3 THEN '%5E' || o || '_AV_1997.csv' ELSE o || '_B+x_AV.json' END AS path,
               CASE o_orderkey % 5 WHEN 3 THEN '^' || o WHEN 4 THEN o || '_B+x' ELSE o END AS ticker
        FROM (SELECT o_orderkey, 'O' || CAST(o_orderkey AS VARCHAR) AS o FROM orders) x""",
})

_POSITIONS = f"SELECT ticker, row_number() OVER (ORDER BY ticker) - 1 AS position FROM ({_UNIVERSE}) u"
ORACLES["universe_positions"] = _POSITIONS
ORACLES["universe_resume"] = f"SELECT * FROM ({_POSITIONS}) p WHERE position >= 1000"

_WIDE_LONG = f"""
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS "date",
         arg_min(l_extendedprice, {_LI_ORD}) AS open, max(l_extendedprice * (1 + l_tax)) AS high,
         min(l_extendedprice * (1 - l_discount)) AS low,
         arg_max(l_extendedprice * (1 - l_discount) * (1 + l_tax), {_LI_ORD}) AS close,
         arg_max(l_extendedprice * (1 - l_discount), {_LI_ORD}) AS adj_close,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS volume,
         sum(round(l_tax * 100)) AS dividends, CAST(count(*) AS DOUBLE) AS order_lines
  FROM lineitem GROUP BY l_suppkey, date_trunc('quarter', l_shipdate)"""

# a line of a file has a cell for each of its symbols: those without rows in a quarter are missing there
_WIDE_GRID = f"""
  SELECT s.ticker, q."date", w.* EXCLUDE (ticker, "date"), w.ticker IS NOT NULL AS complete
  FROM (SELECT DISTINCT 'S' || CAST(l_suppkey AS VARCHAR) AS ticker, l_suppkey % 7 AS batch FROM lineitem) s
  JOIN (SELECT DISTINCT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS "date", l_suppkey % 7 AS batch FROM lineitem) q
    ON s.batch = q.batch
  LEFT JOIN ({_WIDE_LONG}) w ON w.ticker = s.ticker AND w."date" = q."date\""""

ORACLES["wide_file_parse"] = _WIDE_GRID
ORACLES["wide_file_bars"] = f"""
  WITH kept AS (
    SELECT * FROM ({_WIDE_LONG}) c WHERE NOT EXISTS (SELECT 1 FROM ({_WIDE_LONG}) z WHERE z.ticker = c.ticker AND z.adj_close <= 0)),
  w AS (
    SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY "date") AS prev,
           first_value(adj_close) OVER (PARTITION BY ticker ORDER BY "date"
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base
    FROM kept)
  SELECT 'YAHOO' AS source, ticker, {_label('"date"')} AS "quarter", open, high, low, close, adj_close AS adjusted_close,
         CAST(volume AS BIGINT) AS volume, dividends AS dividend_amount, CAST(0.0 AS DOUBLE) AS split_coefficient,
         {_qend('"date"')} AS "date",
         round((adj_close / NULLIF(prev, 0) - 1) * 100, 2) + 0.0 AS pct_change,
         round((adj_close - base) / NULLIF(base, 0) * 100, 2) + 0.0 AS compound_return
  FROM w"""

ORACLES["request_url_forms"] = """
  WITH p AS (
    SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
           regexp_extract(url, '^https?://[^/?#]+(.*)$', 1) AS path, starts_with(url, 'https://') AS secure,
           regexp_extract(html, '<title>([^<]*)', 1) AS title
    FROM pages)
  SELECT page_id, CASE WHEN secure THEN 'https://' ELSE 'http://' END || host || '/v2' || path AS flagged,
         'https://' || host || '/api' || path AS joined,
         'https://api.example.com/repos/' || url_encode(host) || '/' || url_encode(title) || '?page=1' AS templated
  FROM p"""

ORACLES["json_history_records"] = """
    SELECT 'FMP' AS source, 'C' || CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS "date",
           o_totalprice AS open, o_totalprice + 1 AS high, o_totalprice - 1 AS low, o_totalprice AS close,
           o_totalprice / 2 AS adjusted_close, o_orderkey AS volume,
           CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) - 1 AS INTEGER) AS place
    FROM orders"""
