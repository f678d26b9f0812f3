"""Word scanning and hashing over Arrow batches, vectorised with numpy.

Every function here works on the UTF-8 bytes of one batch inside a Spark task. Both word
definitions in use are unions of byte classes (all bytes >= 0x80 are word bytes), so no decoding
is needed. Word hashes are 64-bit: a polynomial over random byte codes, then a finaliser.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 17
CHUNK_BYTES = 1 << 20

WHITE = bytes([0x20, *range(0x09, 0x0E)])
SPACED = np.ones(256, bool)  # words [^\x20\x09-\x0D]+
SPACED[list(WHITE)] = False
ALNUM = np.zeros(256, bool)  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)


def thrifty(f: Callable) -> Callable:
    """f, of batches or of a group's table, after which the worker gives freed memory back, as it lives on beside later stages."""

    def release() -> None:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    def batches(held):
        yield from f(held)
        release()

    def group(rows: pa.Table) -> pa.Table:
        out = f(rows)
        release()
        return out

    return batches if inspect.isgeneratorfunction(f) else group


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U) * U(BASE))
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        n = max(n, BLOCK + 4096)
        for key, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, U(base), dtype=U)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def hash_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _power_table(hi - lo + 1)
        total = np.zeros(hi - lo + 1, U)
        np.cumsum(BYTE_CODE[codes[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(U)
        i = j
    return mix(out)


class Words:
    """The words of consecutive texts: data (folded bytes), starts, ends, hash, first (word offsets by text), doc."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: bool = True):
        self.raw, self.offsets = raw, offsets
        held = raw.tobytes()
        self.data = np.frombuffer(held.translate(FOLD.tobytes()), np.uint8) if fold else raw
        m = np.frombuffer(held.translate((is_word[FOLD] if fold else is_word).tobytes()), bool)
        before, after = np.zeros_like(m), np.zeros_like(m)
        if len(m):
            before[1:], after[:-1] = m[:-1], m[1:]
            before[offsets[offsets < len(m)]] = False
            after[offsets[offsets > 0] - 1] = False
        self.starts, self.ends = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = hash_spans(self.data, self.starts, self.ends)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the windows of n words inside one text, and their hashes."""
        size = len(self.hash) - n + 1
        if size <= 0:
            return np.empty(0, np.int64), np.empty(0, U)
        at = np.flatnonzero(self.doc[:size] == self.doc[n - 1 :])
        total = np.zeros(len(at), U)
        for k in range(n):
            total = total * U(0xD6E8FEB86659FD93) + self.hash[at + k]
        return at, mix(total + U(n))

    def joined(self, i: int, n: int) -> bytes:
        return b" ".join(self.data[self.starts[k] : self.ends[k]].tobytes() for k in range(i, i + n))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column, is_word: np.ndarray, fold: bool = True, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, Words) over whole texts, some megabytes at a time."""
    raw, offsets = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1))
        yield i, j, Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], is_word, fold)
        i = j


def words_of(text: str | None, is_word: np.ndarray, fold: bool = True) -> Words:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), is_word, fold)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    d = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
