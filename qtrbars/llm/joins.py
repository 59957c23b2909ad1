"""Joins that stay even when some keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than 1 / HOT of all rows is hot: there are fewer than HOT.
HOT = 1000


def join_heavy(rows: DataFrame, found: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``found``, which has a key once and in ``weight`` the rows that have it.

    Keys with over a thousandth of the rows come from a broadcast of fewer than
    ``HOT`` rows, whatever the tables; the others from a join in which no key is hot.
    """
    total = found.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT > total
    few = F.broadcast(found.where(hot))
    rest = rows.join(few.select(*on), on, "left_anti").join(found.where(~hot), on)
    return rows.join(few, on).unionByName(rest)
