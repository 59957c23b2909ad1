"""Running sums by key, over rows in order, of which no task holds a key.

``ordered`` range-partitions rows by key and order, so that a key with many
rows lies in several partitions; the rows are checkpointed, as range bounds
are drawn by sampling and would differ when drawn again. ``running`` then
streams through each partition; what a partition takes over from those before
it is worked out from one row a partition (its first and last key and the
last one's sums), which is all that the driver sees. Sums are modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

#: Column that holds a row's partition in an ordered frame.
PART = "__part"


def ordered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``df`` sorted by ``key`` (a bigint, not null) and ``order`` over its partitions,
    checkpointed. Rows with equal order may come in any order."""
    shared_dir(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
            .withColumn(PART, F.spark_partition_id()).checkpoint())


def _sums(batches: Iterator[pa.RecordBatch], key: str, names: list[str], carries: dict) -> Iterator[tuple]:
    """(batch, keys, inclusive sums of each name); ``carries``: what a partition starts with."""
    have, state = None, [np.uint64(0)] * len(names)
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        if first:
            have, state = carries.get(batch.column(PART)[0].as_py(), (None, state))
            first = False
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        starts, which = np.flatnonzero(new), np.cumsum(new) - 1
        outs = []
        for j, name in enumerate(names):
            value = np.asarray(batch.column(name)).astype(np.int64).view(np.uint64)
            total = np.cumsum(value)
            base = total[starts] - value[starts]
            if have is not None and keys[0] == have:
                base[:1] -= np.uint64(state[j])
            outs.append(total - base[which])
        have, state = keys[-1], [o[-1] for o in outs]
        yield batch, keys, outs


def running(df: DataFrame, key: str, sums: dict[str, tuple[str, str]], last: str | None = None) -> DataFrame:
    """``df``, which is ``ordered`` or made from such a frame without a shuffle, with the running sums of columns.

    ``sums``: column -> names of the sum up to and with a row, and up to the row
    before it. ``last``: name of a flag (0 or 1) of a key's last row.
    """
    names = list(sums)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = part = None
        for batch, keys, outs in _sums(batches, key, names, {}):
            if first is None:
                first, part = int(keys[0]), batch.column(PART)[0].as_py()
            end = int(keys[-1]), [int(o[-1].view(np.int64)) for o in outs]
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first]), pa.array([end[0]]), pa.array([end[1]], pa.list_(pa.int64()))],
                names=["part", "first", "last", "sums"])

    found = sorted(df.select(PART, key, *names).mapInArrow(
        summary, "part int, first bigint, last bigint, sums array<bigint>").collect())
    carries, follows, have, state = {}, {}, None, [0] * len(names)
    for k, (part, first, end, own) in enumerate(found):
        carries[part] = (have, [np.uint64(x % 2 ** 64) for x in state])
        follows[part] = found[k + 1][1] if k + 1 < len(found) else None
        state = [a + b for a, b in zip(state, own)] if first == end == have else list(own)
        have = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, keys: np.ndarray, outs: list, following) -> pa.RecordBatch:
            columns = list(batch.columns)
            for name, out in zip(names, outs):
                value = np.asarray(batch.column(name)).astype(np.int64).view(np.uint64)
                columns += [pa.array(out.view(np.int64)), pa.array((out - value).view(np.int64))]
            if last:
                ends = np.ones(len(keys), np.int32)
                ends[:-1] = keys[1:] != keys[:-1]
                ends[-1] = following is None or following != keys[-1]
                columns.append(pa.array(ends))
            return pa.RecordBatch.from_arrays(columns, schema.names)

        held = None
        for now in _sums(batches, key, names, carries):
            if held is not None:
                yield made(*held, now[1][0])
            held = now
        if held is not None:
            yield made(*held, follows[held[0].column(PART)[0].as_py()])

    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, T.LongType()) for pair in sums.values() for n in pair]
                          + ([T.StructField(last, T.IntegerType())] if last else []))
    return df.mapInArrow(run, schema)
