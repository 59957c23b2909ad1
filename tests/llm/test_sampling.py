"""Bounded samples equal the plain order and limit, whatever the cut of the hash range."""

import pytest
from pyspark.sql import functions as F

from qtrbars.llm import sampling


@pytest.mark.parametrize("rows,n,keep", [(0, 5, 1), (3, 5, 1), (5000, 10, 1), (5000, 10, 400), (5000, 10, 4000)])
def test_least_by_hash_is_order_and_limit(spark, rows, n, keep):
    # of every ``keep`` rows one survives the preparation, so that the cut must be widened
    df = spark.range(rows).select((F.col("id") % 4000).alias("id"))
    key = F.xxhash64("id")
    prepare = lambda d: d.where(F.col("id") % keep == 0).select(key.alias("o"), "id")
    got = sampling.least_by_hash(df, key, n, ["o", "id"], prepare)
    assert got == prepare(df).orderBy("o", "id").limit(n).collect()


def test_one_key_of_all_rows(spark):
    df = spark.range(3000).select(F.lit(7).alias("id"))
    key = F.xxhash64("id")
    got = sampling.least_by_hash(df, key, 10, ["o"], lambda d: d.select(key.alias("o")))
    assert len(got) == 10
