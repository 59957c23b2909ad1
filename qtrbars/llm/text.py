"""Byte-level text helpers: numpy over one bounded slice of an Arrow batch.

All hashes are functions of content alone (no seeds drawn at run time), so a
task that is run again on another executor yields the same rows.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single document is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first, last) row ranges whose text is at most ``limit`` bytes
    (or one longer row)."""
    _, off = text_buffer(column)
    first, n = 0, len(off) - 1
    while first < n:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Rolling:
    """Hashes of any byte range of a buffer from one prefix sum.

    The hash of ``b[s:e]`` is sum(T[b[i]] * R**(i - s)) modulo 2**64, mixed.
    ``seed`` picks independent T and R; two seeds make a 128-bit identity.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        n = len(data) + 1
        base = int(splitmix(np.array([1000 + seed], np.uint64))[0]) | 5
        known = self._powers.get(seed)
        if known is None or len(known[0]) < n:
            size = max(n, 1 << 16)
            known = tuple(self._raised(b, size) for b in (base, pow(base, -1, 1 << 64)))
            if size <= CHUNK_BYTES + 1:  # kept as long as the Python worker is
                self._powers[seed] = known
        self.back = known[1]
        table = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(977 * (seed + 1)))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(table[data] * known[0][:n - 1], out=self.sums[1:])

    @staticmethod
    def _raised(base: int, size: int) -> np.ndarray:
        """Powers of the base modulo 2**64, by doubling."""
        out = np.ones(size, np.uint64)
        k = 1
        while k < size:
            np.multiply(out[:min(k, size - k)], np.uint64(pow(base, k, 1 << 64)), out=out[k:2 * k])
            k *= 2
        return out

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return splitmix((self.sums[ends] - self.sums[starts]) * self.back[starts]
                        + (ends - starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k-byte window, by start."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return splitmix((self.sums[k:] - self.sums[:-k]) * self.back[:n] + np.uint64(k))


def gram_hash(data: np.ndarray, words: int) -> np.ndarray:
    """Hash of every run of 8 * ``words`` bytes, by start."""
    n = len(data) - 8 * words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)
    odd = splitmix(np.arange(words, dtype=np.uint64) + np.uint64(0x5851F42D)) | np.uint64(1)
    total = eight[:n] * odd[0]
    for j in range(1, words):
        total += eight[8 * j:8 * j + n] * odd[j]
    return splitmix(total)


def release() -> None:
    """Give memory that was freed back to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives memory back when it is through."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word ``[^\\x20\\x09-\\x0D]+``; words never
    cross rows. These bytes occur in UTF-8 only as themselves."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off[:-1]] = True
    edge[n] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    rows = np.searchsorted(off, starts, side="right") - 1
    return starts, ends, rows


#: Words of more bytes are hashed by a digest.
LONG_WORD = 512


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word ``data[starts:ends]``; ``seed`` picks another one.

    A word's bytes are mixed in eight at a time, after its length, so words of
    one length up to eight bytes never collide, and no pattern in the bytes
    carries over to the hash as it does with polynomials modulo 2**64.
    """
    size = ends - starts
    state = splitmix(size.astype(np.uint64) + np.uint64(0xC2B2AE3D27D4EB4F * (seed + 1) % 2 ** 64))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    todo, done = np.arange(len(starts)), 0
    while len(todo) and done < LONG_WORD:
        left = size[todo] - done
        value = eight[starts[todo] + done]
        short = left < 8
        value[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        state[todo] = splitmix(state[todo] ^ value)
        done += 8
        todo = todo[left > 8]
    for i in todo.tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=bytes([seed])).digest()
        state[i] ^= np.frombuffer(digest, "<u8")[0]
    return state


def window_hash(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive word hashes (len(words) - k + 1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = splitmix(np.arange(k, dtype=np.uint64) + np.uint64(31 * (seed + 7))) | np.uint64(1)
    total = words[:n] * odd[0]
    for j in range(1, k):
        total += words[j:j + n] * odd[j]
    return splitmix(total)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    have, out = 1, values
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = w - have
    return np.minimum(out[:n], out[rest:rest + n])
