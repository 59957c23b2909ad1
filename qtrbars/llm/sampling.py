"""Bounded samples of large tables: the rows least by a hash.

``orderBy(hash).limit(n)`` alone makes every partition send its own ``n``
least rows, so what reaches one place grows with the table. Here a cut of the
hash range, set from the table's row count, lets through about ``SPARE * n``
rows over all partitions; were they fewer than ``n``, the cut is widened. The
result is that of ``orderBy(hash).limit(n)`` whatever the cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Rows let through, as a multiple of those wanted.
SPARE = 4
#: How much the cut is widened each time.
WIDEN = 16


def least_by_hash(df: DataFrame, key: Column, n: int, order: list[str],
                  prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> list[Row]:
    """The first ``n`` rows, by ``order``, of ``prepare(df)``.

    ``key`` is a 64-bit hash over ``df``, and ``order`` starts with its column
    in ``prepare(df)``, which may drop rows but not make them. An empty table
    gives no rows; a table of fewer than ``n`` gives them all.
    """
    share = SPARE * n / max(df.count(), 1)
    while True:
        near = df if share >= 1 else df.where(key < F.lit(int(share * 2.0 ** 64) - 2 ** 63))
        found = prepare(near).orderBy(*order).limit(n).collect()
        if len(found) >= n or share >= 1:
            return found
        share *= WIDEN
