"""Byte-level BPE: texts to ids by a file of ranks, and ids to bytes.

A text is cut by the vocabulary's pattern. A piece that is a token itself gets its id; any other is
merged: a segment tree over its byte positions holds the least (rank of the pair that starts there,
position), so its root names the leftmost pair of the lowest rank. A merge takes the second part out and
gives the merged part and its live neighbour before it their new pairs, three updates of logarithmic
cost. Short pieces have their trees as rows of one array and merge once each in every step (`merged_rows`);
long ones are merged alone (`merged`). Pieces recur, so a task keeps the ids of those it met, up to a bound.

Documents are independent: one pass without a shuffle. Defined results: a null or empty text has no ids,
null ids decode to no bytes; an id that the file lacks is an error; an empty table gives no row; rows are
kept as they are, repeated ones too, and columns that clash with the new one's name stay beside it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import table, thrifty

NONE = 1 << 62
LAST = (1 << 63) - 1
#: Pieces whose ids a worker keeps; bytes of a piece that is merged in a row, and rows of one array.
KEPT, SHORT, ROWS = 1 << 19, 64, 4096
SLICE_BYTES = 4 << 20


@lru_cache(4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    n, rank = len(piece), ranks.get
    size = 1 << max(n - 1, 1).bit_length()
    shift = size.bit_length()
    tree, after, before = [NONE] * (2 * size), list(range(1, n + 1)), list(range(-1, n - 1))

    def pair(start: int, end: int) -> int:
        r = rank(piece[start:end])
        return NONE if r is None else r << shift | start

    def put(at: int, key: int) -> None:
        at += size
        tree[at] = key
        while at > 1:
            at >>= 1
            a, b = tree[2 * at], tree[2 * at + 1]
            low = a if a < b else b
            if tree[at] == low:
                break
            tree[at] = low

    for i in range(n - 1):
        tree[size + i] = pair(i, i + 2)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] != NONE:
        i = tree[1] & ((1 << shift) - 1)
        gone = after[i]
        end = after[i] = after[gone]
        put(gone, NONE)
        if end < n:
            before[end] = i
            put(i, pair(i, after[end]))
        else:
            put(i, NONE)
        if before[i] >= 0:
            put(before[i], pair(before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


@lru_cache(4)
def stand_ins(pattern: str) -> dict[int, int]:
    """Characters that `regex` and the tiktoken library take for different classes (they know different versions of
    Unicode), each with one that both take for what the library does."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    out = {}
    for name, inside in ((r"\p{L}", "ǂ"), (r"\p{N}", "²"), (r"\s", " ")):
        if name in pattern:
            one = tiktoken.Encoding("class", pat_str=name, mergeable_ranks={bytes([k]): k for k in range(256)}, special_tokens={})
            theirs, ours = set(bytes(one.encode_ordinary(every)).decode()), set(regex.findall(name, every))
            out |= {ord(c): 0x2603 for c in ours - theirs if ord(c) not in out} | {ord(c): ord(inside) for c in theirs - ours}
    return out


class Pairs:
    """The rank of the token that two tokens make together."""

    def __init__(self, ranks: dict[bytes, int]):
        at, keys, out = ranks.get, [], []
        for word, rank in ranks.items():
            for k in range(1, len(word)):
                a, b = at(word[:k]), at(word[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    out.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.ranks = np.append(np.array(keys, np.int64)[order], LAST), np.append(np.array(out, np.int64)[order], -1)
        self.byte = np.array([at(bytes([k]), -1) for k in range(256)])
        self.two = self.find(np.repeat(self.byte, 256), np.tile(self.byte, 256))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where they make no token; an id of -1 makes none."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], -1)


def merged_rows(pieces: list[bytes], leaves: int, pairs: Pairs) -> list[list[int]]:
    """The ids of pieces of two to `leaves` bytes, whose trees are the rows of one array."""
    n, shift, levels = len(pieces), leaves.bit_length(), leaves.bit_length() - 1
    size = np.array([len(p) for p in pieces])
    width = leaves + 2  # places 0 .. leaves - 1 of bytes, one after them, and one for "none before"
    raw = np.zeros((n, width), np.int64)
    held = np.arange(width) < size[:, None]
    raw[held] = np.frombuffer(b"".join(pieces), np.uint8)
    ids = np.where(held, pairs.byte[raw], -1).ravel()
    after = np.minimum(np.arange(width) + 1, size[:, None]).ravel()
    before = np.tile(np.arange(width) - 1, n)
    before[::width] = leaves + 1
    tree = np.full((n, 2 * leaves), NONE)
    first = pairs.two[raw[:, :leaves] * 256 + raw[:, 1 : leaves + 1]]
    tree[:, leaves:] = np.where(held[:, 1 : leaves + 1] & (first >= 0), first << shift | np.arange(leaves), NONE)
    for level in range(levels - 1, -1, -1):
        lo = 1 << level
        tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
    tree = np.concatenate((tree, np.full((n, 2), NONE)), axis=1)  # a spare leaf of "none before"
    deep, live = 2 * leaves + 2, np.arange(n)
    tree = tree.ravel()
    while True:
        root = tree[live * deep + 1]
        live = live[root != NONE]
        if not len(live):
            break
        root = root[root != NONE]
        row, base = live * width, live * deep
        i, new = root & ((1 << shift) - 1), root >> shift
        gone = after[row + i]
        end = after[row + gone]
        ids[row + i] = new
        after[row + i] = end
        before[row + end] = i
        last = before[row + i]
        right, left = pairs.find(new, ids[row + end]), pairs.find(ids[row + last], new)
        tree[base + leaves + gone] = NONE
        tree[base + leaves + i] = np.where(right < 0, NONE, right << shift | i)
        tree[base + leaves + last] = np.where(left < 0, NONE, left << shift | last)
        nodes = leaves + np.stack((gone, i, np.where(last < leaves, last, i)))
        for _ in range(levels):
            nodes >>= 1
            at = base + 2 * nodes
            tree[base + nodes] = np.minimum(tree[at], tree[at + 1])
    out = []
    for k in range(n):
        i, own, row = 0, [], k * width
        while i < size[k]:
            own.append(int(ids[row + i]))
            i = int(after[row + i])
        out.append(own)
    return out


class Codec:
    """Ids of texts and bytes of ids, by one file of ranks."""

    def __init__(self, path: str, pattern: str, unlike: dict[int, int]):
        self.ranks, self.cut, self.unlike = ranks_of(path), regex.compile(pattern), unlike
        self.odd = frozenset(map(chr, unlike))
        self.pieces, self.words = {}, {r: w for w, r in self.ranks.items()}

    @cached_property
    def pairs(self) -> Pairs:
        return Pairs(self.ranks)

    def split(self, text: str) -> list[str]:
        if text.isascii() or self.odd.isdisjoint(text):
            return self.cut.findall(text)
        return [text[m.start() : m.end()] for m in self.cut.finditer(text.translate(self.unlike))]

    def learn(self, new: list[str]) -> None:
        """Adds the ids of new pieces."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.pieces[piece] = (whole,)
            elif len(raw) > SHORT:
                self.pieces[piece] = tuple(merged(raw, self.ranks))
            else:
                groups.setdefault(max(8, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for leaves, own in groups.items():
            for k in range(0, len(own), ROWS):
                names, raws = zip(*own[k : k + ROWS], strict=True)
                self.pieces.update(zip(names, map(tuple, merged_rows(list(raws), leaves, self.pairs)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of some texts."""
        if len(self.pieces) > KEPT:
            self.pieces.clear()
        cut = [self.split(t) for t in texts]
        self.learn([p for p in set(chain.from_iterable(cut)) if p not in self.pieces])
        return [np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, c)), np.int32) for c in cut]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


@lru_cache(2)
def codec(path: str, pattern: str, unlike: tuple) -> Codec:
    return Codec(path, pattern, dict(unlike))


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate((np.empty(0, np.int32), *found)), pa.int32()))


def _slices(batch: pa.RecordBatch, sizes: list[int]):
    """Parts of a batch of some megabytes."""
    first, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += size
    yield batch.slice(first)


def encoding(path: str, pattern: str, text: int) -> Callable:
    """A function of batches that adds the ids of the text in one column."""
    unlike = tuple(stand_ins(pattern).items())

    def encode(batches):
        held = codec(path, pattern, unlike)
        for batch in batches:
            sizes = [0 if s is None else len(s) for s in batch.column(text).to_pylist()]
            for part in _slices(batch, sizes):
                ids = held.encode([s or "" for s in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids)], [str(k) for k in range(part.num_columns + 1)])

    return encode


def decoding(path: str, ids: int) -> Callable:
    """A function of batches that adds the bytes of the ids in one column."""

    def decode(batches):
        held = codec(path, "", ())
        for batch in batches:
            raw = [held.decode(x.values.to_pylist() if x.is_valid else []) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [str(k) for k in range(batch.num_columns + 1)])

    return decode


def _named(columns: list[str], f: Callable) -> Callable:
    def run(batches):
        for batch in f(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, columns)

    return thrifty(run)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """df with a column of the text's ids (array of integers)."""
    return df.mapInArrow(_named([*df.columns, out], encoding(path, pattern, df.columns.index(text))), f"{_ddl(df)} `{out}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """df with a column of the ids' bytes."""
    return df.mapInArrow(_named([*df.columns, out], decoding(path, df.columns.index(ids))), f"{_ddl(df)} `{out}` binary")


def _ddl(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, number of ids, SHA-256 of the ids (as little-endian 32-bit integers) and of the bytes they decode to.

    Encoding and decoding are those of the operators, chained in one worker."""
    forth, back = encoding(path, pattern, 1), decoding(path, 2)

    def digests(batches):
        for batch in back(forth(batches)):
            ids = [x.values.to_numpy(zero_copy_only=False).astype("<u4") for x in batch.column(2)]
            columns = [
                batch.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in batch.column(3)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(text)).mapInArrow(thrifty(digests), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
