"""Payload tests and parsers as column expressions.

A payload is the whole text one vendor returned for one ticker. Everything
here works on that text column with Spark's built-in string, JSON and
higher-order array functions, so classification and parsing stay inside the
JVM (no Python per row) and need no shuffle: one payload row in, one row out.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import parse_day

# Fixed values that must equal the source job's to classify the same way.
# Messages meaning "rate limited / quota", searched in the payload head:
AV_RATE_MESSAGES = ["exceeded the DAILY quota", "exceeded the rate limit per minute",
                    "not subscribed to this API"]
FMP_RATE_MESSAGES = AV_RATE_MESSAGES + ["Limit Reach"]
RATE_MESSAGES = {"AV": AV_RATE_MESSAGES, "FMP": FMP_RATE_MESSAGES}
# Marker of an unknown ticker in an AV error body:
UNKNOWN_TICKER_MESSAGE = "Invalid API call"
# Size of the payload head searched for rate messages (characters):
HEAD_CHARS = 100
# An AV price CSV needs this many header fields (9 with the ticker column):
AV_MIN_FIELDS = 8
# Column names of the AV daily CSV and of one FMP history record:
AV_FIELDS = ["timestamp", "open", "high", "low", "close", "adjusted_close", "volume",
             "dividend_amount", "split_coefficient"]
FMP_RECORD = T.StructType([
    # every field is read as its text, so that a malformed or out-of-range
    # number is seen instead of silently nulled with its neighbours
    T.StructField(name, T.StringType())
    for name in ("date", "open", "high", "low", "close", "adjClose", "volume")
])
FMP_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()),
                           T.StructField("historical", T.ArrayType(FMP_RECORD))])

STATUSES = ["ok", "rate_limited", "not_available", "unparseable", "unrecognized"]
# Texts of a missing number, as CSV readers take them (lower case):
MISSING_NUMBERS = ["", "nan", "null", "none", "n/a", "na"]
#: The largest 64-bit integer, and the doubles that don't fit one: this size or more.
_LONG_MOST = 2 ** 63 - 1
_LONG_LIMIT = 9.223372036854775807e18
#: Line breaks and commas inside quotes, and what stands for them while records
#: and cells are split (private-use characters).
_SHIELDED, _SHIELDS = "\n\r,", "\ue000\ue001\ue002"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def head_text(payload, n: int = HEAD_CHARS) -> Column:
    return F.substring(_c(payload), 1, n)


def contains_any(text, markers) -> Column:
    """True when the text contains any marker (plain searches: a regex of
    several markers costs many times as much)."""
    return reduce(or_, [_c(text).contains(m) for m in markers])


def is_answer(payload, vendor: str) -> Column:
    """False for a rate-limit message of the vendor, true for all else (nulls too)."""
    if vendor not in RATE_MESSAGES:
        return F.lit(True)
    return ~F.coalesce(contains_any(head_text(payload), RATE_MESSAGES[vendor]), F.lit(False))


def shielded(payload) -> Column:
    """The payload with the line breaks and commas inside quotes replaced, so
    that records end at line breaks and cells at commas.

    Cut at its quotes, a text's pieces are outside and inside quotes by turns,
    so one pass over the pieces does; a doubled quote inside a quoted cell is an
    empty piece outside. Texts without quotes are left as they are.
    """
    text = _c(payload)
    pieces = F.transform(F.split(text, '"'), lambda x, i: F.when(i % 2 == 1, F.translate(x, _SHIELDED, _SHIELDS)).otherwise(x))
    return F.when(text.contains('"'), F.array_join(pieces, '"')).otherwise(text)


def lines(payload) -> Column:
    """Records of a CSV text; a quoted cell may go over several lines."""
    return F.split(shielded(payload), "\r?\n")


def data_lines(payload) -> Column:
    """Non-blank records after the header."""
    return F.filter(lines(payload), lambda x, i: (i > 0) & (F.trim(x) != ""))


def header_fields(payload) -> Column:
    return csv_cells(F.try_element_at(lines(payload), F.lit(1)))


def csv_cells(record: Column) -> Column:
    """Trimmed cells of a record of ``lines``; a quoted cell may hold commas and
    line breaks, and a doubled quote in it stands for one."""
    def plain(cell):
        return F.trim(cell)

    def unquoted(cell):
        cell = F.trim(cell)
        inner = F.replace(F.regexp_replace(cell, '^"|"$', ""), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"'), F.trim(F.translate(inner, _SHIELDS, _SHIELDED))).otherwise(cell)
    cells = F.split(record, ",")
    return F.when(record.contains('"'), F.transform(cells, unquoted)).otherwise(F.transform(cells, plain))


def _missing(text: Column) -> Column:
    """True where a text stands for a missing number."""
    return text.isNull() | F.lower(F.trim(text)).isin(MISSING_NUMBERS)


def _num(text: Column) -> Column:
    """The number, null where there is none (NaN counts as none)."""
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def _whole(text: Column, number: Column) -> Column:
    """A 64-bit integer, exact where it is written as one, else truncated
    from ``number``, its double; null beyond the range."""
    return F.coalesce(F.trim(text).try_cast("bigint"), F.when(F.abs(number) < _LONG_LIMIT, number.cast("bigint")))


def _unusable_rows(rows: Column) -> Column:
    """A date or number that doesn't parse, or volumes whose sizes sum beyond
    the 64-bit range over the whole payload (else no quarter's sum overflows).
    The sum is exact."""
    exact = "decimal(38,0)"
    volumes = F.aggregate(rows, F.lit(0).cast(exact),
                          lambda acc, r: (acc + F.coalesce(F.abs(r["volume"].cast(exact)), F.lit(0).cast(exact))).cast(exact))
    return F.exists(rows, lambda r: r["date"].isNull() | r["_bad"]) | (volumes > F.lit(_LONG_MOST).cast(exact))


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def field_positions(header: Column) -> Column:
    """1-based position of each AV field in the header (0 when absent)."""
    return F.array(*[F.array_position(header, f).cast("int") for f in AV_FIELDS])


def _typed(row: Column, i: Column, day: Column, text, numbers: list[str], volume: str) -> Column:
    """A typed row from the texts of its fields (``text(name)``) and the numbers
    read from them once (``row['n']``, in the order of ``numbers``)."""
    value = {f: F.get(row["n"], F.lit(k)) for k, f in enumerate(numbers)}
    whole = _whole(text(volume), value[volume])
    bad = [value[f].isNull() & ~_missing(text(f)) for f in numbers if f != volume]
    names = {"adjClose": "adjusted_close"}
    return F.struct(day.alias("date"),
                    *[(whole if f == volume else value[f]).alias(names.get(f, f)) for f in numbers],
                    i.alias("_seq"),
                    _any([*bad, whole.isNull() & ~_missing(text(volume))]).alias("_bad"))


def av_rows_from(body: Column, positions: Column) -> Column:
    """Typed rows from data records and header positions (both computed once
    per payload). Each record is split once and each number read once, so the
    cost is linear in the payload size."""
    pos = {f: F.element_at(positions, k + 1) - 1 for k, f in enumerate(AV_FIELDS)}  # -1 when absent
    numbers = [f for f in AV_FIELDS if f != "timestamp"]
    read = F.transform(F.transform(body, csv_cells), lambda cells: F.struct(
        cells.alias("t"), F.array(*[_num(F.get(cells, pos[f])) for f in numbers]).alias("n")))

    def row(x, i):
        return _typed(x, i, parse_day(F.get(x["t"], pos["timestamp"])), lambda f: F.get(x["t"], pos[f]), numbers, "volume")
    return F.transform(read, row)


def av_rows(payload) -> Column:
    """Array of typed daily rows of an AV CSV payload, fields found by header
    name. An unparseable date or number stays null and marks the row ``_bad``
    and so the payload (see ``av_status``). For many payloads prefer
    ``with_av_parse``, which stages the intermediate arrays as columns."""
    return av_rows_from(data_lines(payload), field_positions(header_fields(payload)))


def av_status_from(head: Column, body: Column, header: Column, rows: Column) -> Column:
    """First match wins: rate_limited (message in the head), ok (a data line
    and >= 8 header fields; every date and number parses, else unparseable),
    not_available (a '{' header field and an 'Invalid API call' line),
    unrecognized (anything else, e.g. header only)."""
    n_data = F.size(body)
    return (F.when(contains_any(head, AV_RATE_MESSAGES), F.lit("rate_limited"))
             .when((n_data >= 1) & (F.size(header) >= AV_MIN_FIELDS),
                   F.when(_unusable_rows(rows), F.lit("unparseable")).otherwise(F.lit("ok")))
             .when((n_data >= 1) & F.array_contains(header, "{")
                   & F.exists(body, lambda x: x.contains(UNKNOWN_TICKER_MESSAGE)),
                   F.lit("not_available"))
             .otherwise(F.lit("unrecognized")))


def av_status(payload) -> Column:
    p = _c(payload)
    return av_status_from(head_text(p), data_lines(p), header_fields(p), av_rows(p))


def stage(df, name: str, expr: Column):
    """Materialise ``expr`` once per row as column ``name``.

    A one-element ``explode`` is a Generate node, which the optimizer does not
    collapse into later projections. Without it, a column referenced inside a
    per-element lambda is inlined back into the lambda and recomputed for
    every element (quadratic in the payload size).
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def with_av_parse(df, payload: str = "payload"):
    """Add ``rows`` and ``status`` to a frame of AV payloads, computing each
    intermediate (lines, header, positions, data lines, rows) once."""
    df = stage(df, "_lines", lines(payload))
    df = stage(df, "_hdr", csv_cells(F.try_element_at(F.col("_lines"), F.lit(1))))
    df = stage(df, "_body", F.filter("_lines", lambda x, i: (i > 0) & (F.trim(x) != "")))
    df = stage(df, "_pos", field_positions(F.col("_hdr")))
    df = stage(df, "rows", av_rows_from(F.col("_body"), F.col("_pos")))
    df = df.withColumn("status", av_status_from(head_text(payload), F.col("_body"),
                                                F.col("_hdr"), F.col("rows")))
    return df.drop("_lines", "_hdr", "_body", "_pos")


def fmp_parsed(payload) -> Column:
    return F.from_json(_c(payload), FMP_SCHEMA)


def fmp_rows(payload=None, hist=None) -> Column:
    """Array of typed daily rows of an FMP JSON payload (or of its parsed
    ``historical`` list, to parse once)."""
    hist = fmp_parsed(payload)["historical"] if hist is None else _c(hist)
    numbers = ["open", "high", "low", "close", "adjClose", "volume"]
    read = F.transform(hist, lambda r: F.struct(r.alias("t"), F.array(*[_num(r[f]) for f in numbers]).alias("n")))
    return F.transform(read, lambda x, i: _typed(x, i, parse_day(x["t"]["date"]), lambda f: x["t"][f], numbers, "volume"))


def fmp_status(payload, hist=None, rows=None) -> Column:
    """First match wins: rate_limited (message in the head), unparseable (not
    a JSON object/array), not_available (empty object or array),
    unrecognized (no 'historical' list, or an empty one), unparseable (a date
    or number that does not parse, volumes beyond the 64-bit range), ok.
    ``rows`` are the payload's ``fmp_rows`` where already computed."""
    p = _c(payload)
    keys = F.json_object_keys(p)
    arr_len = F.json_array_length(p)
    hist = fmp_parsed(p)["historical"] if hist is None else _c(hist)
    rows = fmp_rows(hist=hist) if rows is None else _c(rows)
    return (F.when(contains_any(head_text(p), FMP_RATE_MESSAGES), F.lit("rate_limited"))
             .when(keys.isNull() & arr_len.isNull(), F.lit("unparseable"))
             .when((F.size(keys) == 0) | (arr_len == 0), F.lit("not_available"))
             .when(hist.isNull() | (F.size(hist) == 0), F.lit("unrecognized"))
             .when(_unusable_rows(rows), F.lit("unparseable"))
             .otherwise(F.lit("ok")))


def ticker_from_path(path, source: str | None = None) -> Column:
    """Ticker from a landed file name ``<TICKER>[_<vendor>[_<anything>]].<ext>``:
    the vendor tag and what follows it go (``AAA_AV_2.csv`` -> ``AAA``). A name
    without the tag is the ticker as it stands, as tickers may hold '_'."""
    name = F.regexp_extract(_c(path), r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    if source:
        stem = F.regexp_replace(stem, "_" + re.escape(source) + r"(_.*)?$", "")
    return stem


def request_url(base, path, secure) -> Column:
    """URL from base and path; without the secure flag the base gets an
    explicit http:// scheme."""
    return F.when(_c(secure), F.concat(_c(base), _c(path))) \
            .otherwise(F.concat(F.lit("http://"), _c(base), _c(path)))


def path_segment(value) -> Column:
    """A value as one segment of a URL path: all bytes but letters, digits and
    ``-._~`` are percent-encoded, the slash too."""
    form = F.url_encode(_c(value).cast("string"))  # form encoding: a blank is a plus there
    return F.replace(F.replace(F.replace(form, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def joined_url(base, path) -> Column:
    """URL of a path below a base, by a slash between them."""
    return F.concat(_c(base), F.lit("/"), _c(path))


def template_url(template: str, **values) -> Column:
    """URL from a template such as ``https://host/repos/{owner}/{name}``; each value
    is encoded as a path segment. A null value makes the URL null."""
    pieces = re.split(r"\{(\w+)\}", template)
    unknown = set(pieces[1::2]) ^ set(values)
    if unknown:
        raise ValueError(f"template and values differ in {sorted(unknown)}")
    return F.concat(*[path_segment(values[p]) if k % 2 else F.lit(p) for k, p in enumerate(pieces) if k % 2 or p])


def row_order(date="date", seq="_seq") -> Column:
    """In-payload order of daily rows as one long: the day, then the row's
    position in its payload (a vendor that repeats a date still yields a
    deterministic first/last). Days take 22 bits and an array position 31, so
    no payload is too long for it. A long keeps ``min_by``/``max_by`` in a hash
    aggregate."""
    return (F.unix_date(_c(date)).cast("bigint") * F.lit(1 << 32) + _c(seq).cast("bigint"))
