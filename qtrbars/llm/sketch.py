"""Count-min sketch of 64-bit hashes, built in partitions and merged by Spark.

Every task sketches what it sees and emits only its cells that aren't zero,
cut into slices; the slices are summed in as many tasks as there are slices;
what comes back is one bit a cell (estimated at or over a threshold; one for
eight cells at the higher thresholds, which few cells reach), so the size that
is collected and broadcast is fixed by ``CELL_BITS`` (32 MB, and 4 MB for each
higher threshold) and doesn't grow with the input. Estimates are never
below the count. The more hashes there are for each cell, the more estimates
are over the truth; callers use them to set work aside, never to decide.

``met`` doesn't fill up like that: it counts each hash under a name of
``NAME_BITS`` bits, in tasks that hold a stretch of the names, and only those met
often enough set bits, however many there are of others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .text import release, splitmix, trimmed

DEPTH = 2
CELL_BITS = 27
SLICE_BITS = 6
#: Hashes that a task holds before it emits a sketch.
HELD = 1 << 20

#: A bit stands for 2**COARSE cells at thresholds above 2.
COARSE = 3

#: Bits of a hash's name in ``met``; stretches of names that are counted apart, as a power of two.
NAME_BITS = 40
STRETCH_BITS = 8

_SCHEMA = "slice int, cells binary"
_ZSTD = pa.Codec("zstd", compression_level=1)


def packed(data: bytes) -> bytes:
    """Compressed, after the length."""
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def cells(hashes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Cell of each hash in row ``depth``."""
    return splitmix(hashes ^ np.uint64(0xA5A5 * (depth + 1))) >> np.uint64(64 - bits)


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers: high planes of small numbers then compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def names(hashes: np.ndarray) -> np.ndarray:
    return cells(hashes, DEPTH, NAME_BITS)


def _emit(hashes: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    if not hashes:
        return
    every = np.concatenate(hashes)
    slices, blobs = [], []
    for depth in range(DEPTH):
        found, count = np.unique(cells(every, depth, bits), return_counts=True)
        count = np.minimum(count, 0xFFFF)
        owner = (found >> np.uint64(bits - SLICE_BITS)).astype(np.int64)
        edges = np.searchsorted(owner, np.arange((1 << SLICE_BITS) + 1))
        for s in range(1 << SLICE_BITS):
            a, b = edges[s], edges[s + 1]
            if a < b:
                at = found[a:b] - np.uint64(s << (bits - SLICE_BITS))
                slices.append((depth << SLICE_BITS) + s)
                blobs.append(packed(_planes(np.diff(at, prepend=np.uint64(0))) + _planes(count[a:b])))
    yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(blobs, pa.binary())],
                                     names=["slice", "cells"])


def _emit_names(hashes: list[np.ndarray], stretches: int) -> Iterator[pa.RecordBatch]:
    """The distinct names, by stretch, and of each whether it came more than once."""
    if not hashes:
        return
    found, count = np.unique(names(np.concatenate(hashes)), return_counts=True)
    low = np.uint64(NAME_BITS - stretches)
    owner = (found >> low).astype(np.int64)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    blobs = []
    for a, b in zip(starts, np.append(starts[1:], len(found))):
        at = np.diff(found[a:b] - (np.uint64(owner[a]) << low), prepend=np.uint64(0))
        planes = at.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
        blobs.append(packed(planes + np.packbits(count[a:b] > 1).tobytes()) + int(b - a).to_bytes(4, "little"))
    yield pa.RecordBatch.from_arrays([pa.array(owner[starts], pa.int32()), pa.array(blobs, pa.binary())],
                                     names=["slice", "cells"])


def _read_names(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Names, less the stretch's first, and whether each came more than once."""
    n = int.from_bytes(blob[-4:], "little")
    data = np.frombuffer(unpacked(blob[:-4]), np.uint8)
    at = np.ascontiguousarray(data[:8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(at), np.unpackbits(data[8 * n:], count=n).view(bool)


def _in_tasks(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]],
              emit: Callable[[list[np.ndarray], int], Iterator[pa.RecordBatch]], bits: int) -> DataFrame:
    """What ``emit`` makes of the hashes of each task, some ``HELD`` at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                size += len(h)
                if size >= HELD:
                    yield from emit(held, bits)
                    held, size = [], 0
        yield from emit(held, bits)

    return df.mapInArrow(trimmed(run), _SCHEMA)


def partition_sketches(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]],
                       bits: int = CELL_BITS) -> DataFrame:
    """Slices of sketches of what ``hashes`` gives for each batch."""
    return _in_tasks(df, hashes, _emit, bits)


class Bits:
    """One bit a cell and row; ``holds`` is true where every row's bit is set."""

    def __init__(self, packed: np.ndarray, bits: int, coarse: int = 0):
        self.packed, self.bits, self.coarse = packed, bits, np.uint64(coarse)

    def cells(self, hashes: np.ndarray, depth: int) -> np.ndarray:
        return cells(hashes, depth, self.bits)

    def at(self, found: np.ndarray, depth: int) -> np.ndarray:
        """Whether the bit of each of these cells is set in row ``depth``."""
        at = found >> self.coarse
        byte = self.packed[depth, (at >> np.uint64(3)).astype(np.int64)]
        return (byte >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for depth in range(DEPTH):
            out &= self.at(self.cells(hashes, depth), depth)
        return out


def levels(bitmaps: list[Bits], hashes: np.ndarray) -> np.ndarray:
    """Of bitmaps of one sketch, how many hold each hash."""
    held = np.ones((len(bitmaps), len(hashes)), bool)
    for depth in range(DEPTH):
        found = bitmaps[0].cells(hashes, depth)
        for one, bitmap in zip(held, bitmaps):
            one &= bitmap.at(found, depth)
    return held.sum(axis=0, dtype=np.int8)


def over(sketches: DataFrame, thresholds: list[int], bits: int = CELL_BITS) -> list[Bits]:
    """Merge slices; for each threshold the cells estimated at or over it.

    A threshold above 2 is raised by four times a cell's mean load, so that
    it singles out the same share at any size of the input.
    """
    size = 1 << (bits - SLICE_BITS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob in zip(batch[0].to_pylist(), batch[1]):
                data = unpacked(blob.as_py())
                at = np.cumsum(_numbers(data[:len(data) // 2]).astype(np.int64))
                if s not in sums:
                    sums[s] = np.zeros(size, np.uint32)
                sums[s][at] += _numbers(data[len(data) // 2:])
        for s, total in sums.items():
            load = int(total.sum() // size)
            found = [packed(np.packbits(total >= t if t <= 2 else
                                        (total >= t + 4 * load).reshape(-1, 1 << COARSE).any(axis=1)).tobytes())
                     for t in thresholds]
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([found], pa.list_(pa.binary()))],
                                             names=["slice", "found"])

    parts = DEPTH << SLICE_BITS
    rows = sketches.repartition(parts, "slice").mapInArrow(trimmed(merge), "slice int, found array<binary>").collect()
    out = [Bits(np.zeros((DEPTH, 1 << (bits - 3 - coarse)), np.uint8), bits, coarse)
           for coarse in (0 if t <= 2 else COARSE for t in thresholds)]
    while rows:  # each slice is let go once its bits are in place
        row = rows.pop()
        depth, s = row["slice"] >> SLICE_BITS, row["slice"] & ((1 << SLICE_BITS) - 1)
        for one, data in zip(out, map(unpacked, row["found"])):
            one.packed[depth, s * len(data):(s + 1) * len(data)] = np.frombuffer(data, np.uint8)
    return out


class NameBits(Bits):
    """The same for names: a stretch of names has its own stretch of cells in each row."""

    def __init__(self, packed: np.ndarray, bits: int, stretches: int):
        super().__init__(packed, bits)
        self.stretches = stretches

    def cells(self, hashes: np.ndarray, depth: int) -> np.ndarray:
        name, low = names(hashes), self.bits - self.stretches
        return (name >> np.uint64(NAME_BITS - self.stretches) << np.uint64(low)) | cells(name, depth, low)


def met(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], least: int,
        bits: int = CELL_BITS) -> NameBits:
    """Bits of the hashes met ``least`` (1 or 2) times or more; of others, those hold whose cells these set.

    A task holds the names of one stretch at a time.
    """
    stretches = min(STRETCH_BITS, bits - 3)
    low, size = bits - stretches, 1 << (bits - stretches - 3)

    def bitmaps(s: int, blobs: list[bytes]) -> pa.RecordBatch:
        parts = [_read_names(blob) for blob in blobs]
        every = np.concatenate([found for found, _ in parts])
        if least > 1:
            every.sort()
            every = np.concatenate([every[1:][every[1:] == every[:-1]], *(found[again] for found, again in parts)])
        every += np.uint64(s << (NAME_BITS - stretches))
        rows = []
        for depth in range(DEPTH):
            flags = np.zeros(1 << low, np.uint8)
            flags[cells(every, depth, low)] = 1
            rows.append(packed(np.packbits(flags).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([rows], pa.list_(pa.binary()))],
                                          names=["slice", "found"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = -1, []
        for batch in batches:
            for s, blob in zip(batch[0].to_pylist(), batch[1]):
                if s != now and blobs:
                    yield bitmaps(now, blobs)
                    blobs = []
                now = s
                blobs.append(blob.as_py())
        if blobs:
            yield bitmaps(now, blobs)

    rows = (_in_tasks(df, hashes, _emit_names, stretches).repartition("slice").sortWithinPartitions("slice")
            .mapInArrow(trimmed(merge), "slice int, found array<binary>").collect())
    out = np.zeros((DEPTH, 1 << (bits - 3)), np.uint8)
    while rows:
        row = rows.pop()
        for depth, data in enumerate(map(unpacked, row["found"])):
            out[depth, row["slice"] * size:(row["slice"] + 1) * size] = np.frombuffer(data, np.uint8)
    return NameBits(out, bits, stretches)


def shared(df: DataFrame, value: object) -> Broadcast:
    """A broadcast, written to a file by the driver, which then lets go of what it took to make it."""
    out = df.sparkSession.sparkContext.broadcast(value)
    release()
    return out
