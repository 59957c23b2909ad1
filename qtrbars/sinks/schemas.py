"""Columns of the stored tables; ``source`` and ``ticker`` come last."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _DOUBLE, _TIME = T.StringType(), T.DoubleType(), T.TimestampType()

BAR_SCHEMA = _struct(
    quarter=_TEXT, open=_DOUBLE, high=_DOUBLE, low=_DOUBLE, close=_DOUBLE, adjusted_close=_DOUBLE,
    volume=T.LongType(), dividend_amount=_DOUBLE, split_coefficient=_DOUBLE, date=T.DateType(),
    data_load=_TIME, pct_change=_DOUBLE, compound_return=_DOUBLE, source=_TEXT, ticker=_TEXT)

MANIFEST_SCHEMA = _struct(first_quarter=_TEXT, last_quarter=_TEXT, source=_TEXT, ticker=_TEXT)

RECORD_SCHEMA = _struct(reason=_TEXT, payload=_TEXT, data_load=_TIME, source=_TEXT, ticker=_TEXT)

#: One row per ticker that was ever answered: the table its answer went to
#: (``bars``, ``not_available``, ``quarantine``), which fetch that was, and the
#: SHA-256 of the answer's text.
INDEX_SCHEMA = _struct(state=_TEXT, modified=_TIME, fetch_id=T.LongType(), path=_TEXT, digest=_TEXT,
                       source=_TEXT, ticker=_TEXT)
