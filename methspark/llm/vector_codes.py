"""Product codes of vectors: a codebook for each of some equal parts, fitted by rounds of exact integer means.

Components become integers, floor(scale * x). A round assigns every part to the nearest entry of its
codebook and replaces entries by the floor of their parts' means. The nearest entry is found through a
GNAT over the entries: split points hold the range of their distances to the entries below each child; a
vector's distance to a split point rules out a child whose range lies strictly beyond the best distance so
far. Distances in these tests are square roots rounded away from a false ruling-out; what remains is
compared by exact squared distances, ties to the lower index.

Vectors stay where they are read: each round is one pass in which a task sends one sum for each part,
entry and component. Trees and codebooks are bounded by entries and dimensions, not by rows, and so are the
rows that come to the driver.

Defined results: vectors that are null or hold null or non-finite components are left out; shorter vectors
count as followed by zeros, and so does the last part if the parts do not divide the length; components
are held to +-sqrt(2^62 / dimensions) / 2 so that all distances fit 64 bits; of equal ids the lesser vector
comes first, null ids come last; fewer vectors than entries make a smaller codebook; an empty table gives
no row; repeated rows each get a code, and columns of any name are passed on.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import shared
from ._text import table, thrifty

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BRANCH, LEAF = 4, 3
ROWS = 8192
#: Sums by label that are sent to every executor; beyond it they are joined by label.
BROADCAST_LABELS = 1 << 18
LONG = (1 << 63) - 1


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, -np.inf), -np.inf)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, np.inf), np.inf)


def _squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = points - entry
    return (d * d).sum(axis=1)


@dataclass
class Node:
    """Split points, and for split point i and child j the range of distances from i to what child j holds."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    children: list


def grow(entries: np.ndarray, own: list[int]) -> Node | list[int]:
    """A GNAT over the entries of the given indexes; few of them stay a list."""
    if len(own) <= LEAF:
        return own
    splits = [own[0]]
    away = _squares(entries[own], entries[own[0]])
    while len(splits) < min(BRANCH, len(own)):  # the entry farthest from all split points so far
        splits.append(own[int(np.argmax(away))])
        away = np.minimum(away, _squares(entries[own], entries[splits[-1]]))
        away[[own.index(s) for s in splits]] = -1
    below: list[list[int]] = [[] for _ in splits]
    for k in own:
        if k not in splits:
            below[int(np.argmin(_squares(entries[splits], entries[k])))].append(k)
    low, high = (np.empty((len(splits), len(splits))) for _ in range(2))
    for i, s in enumerate(splits):
        for j, t in enumerate(splits):
            held = below[j] + ([t] if i != j else [])  # its own split point is compared before the child is
            d = np.sqrt(_squares(entries[held], entries[s]).astype(float)) if held else np.zeros(1)
            low[i, j], high[i, j] = _down(d.min()), _up(d.max())
    return Node(splits, low, high, [grow(entries, b) for b in below])


def nearest(tree: Node | list[int], entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index."""
    best, which = np.full(len(points), LONG), np.full(len(points), len(entries))

    def compare(k: int, rows: np.ndarray) -> np.ndarray:
        d = _squares(points[rows], entries[k])
        closer = (d < best[rows]) | ((d == best[rows]) & (k < which[rows]))
        best[rows[closer]], which[rows[closer]] = d[closer], k
        return d

    def visit(node: Node | list[int], rows: np.ndarray) -> None:
        if isinstance(node, list):
            for k in node:
                compare(k, rows)
            return
        alive = np.ones((len(rows), len(node.splits)), bool)
        for i, k in enumerate(node.splits):
            at = np.flatnonzero(alive[:, i])
            if len(at):
                d = np.sqrt(compare(k, rows[at]).astype(float))
                reach = _up(np.sqrt(best[rows[at]].astype(float)))
                beyond = _down(_down(d) - reach)[:, None] > node.high[i]
                within = _up(_up(d) + reach)[:, None] < node.low[i]
                alive[at] &= ~(beyond | within)
        for j, child in enumerate(node.children):
            at = rows[alive[:, j]]
            if len(at) and child:
                visit(child, at)

    visit(tree, np.arange(len(points)))
    return which, best


class Books:
    """The codebooks: parts x entries x components, with their trees."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.trees = [grow(e, list(range(len(e)))) for e in entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances), each rows x parts."""
        cut = vectors.reshape(len(vectors), *self.entries.shape[::2])
        got = [nearest(t, e, np.ascontiguousarray(cut[:, p])) for p, (t, e) in enumerate(zip(self.trees, self.entries, strict=True))]
        return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)

    def text(self) -> str:
        return ",".join(map(str, self.entries.ravel().tolist()))


def finite(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(vector).isNotNull() & ~bad)


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) by row, filled with zeros up to the width."""
    column = column.cast(pa.list_(pa.float64()))
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bound = isqrt((1 << 62) // max(width, 1)) // 2
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -bound, bound).astype(np.int64)
    if len(flat) == len(size) * width:
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def _ints(rows: pa.RecordBatch, at: int, width: int, scale: int):
    for k in range(0, rows.num_rows, ROWS):
        part = rows.slice(k, ROWS)
        yield part, integers(part.column(at), width, scale)


def fit(df: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """The codebooks of df's finite vectors; each round reads df again."""
    kept = finite(df, vector)
    longest = kept.agg(F.max(F.size(vector))).first()[0] or 0
    width = -(-longest // parts) * parts
    first = kept.select(F.col(key).alias("k"), F.col(vector).alias("v")).orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    start = integers(first["v"].combine_chunks(), width, scale) if first.num_rows else np.zeros((0, width), np.int64)
    size = (parts, len(start), width // parts)
    books = Books(np.ascontiguousarray(start.reshape(len(start), parts, size[2]).transpose(1, 0, 2)))
    for _ in range(rounds if len(start) else 0):
        held = books

        def sums(batches, held=held):
            total, count = np.zeros(size, np.int64), np.zeros(size[:2], np.int64)
            for batch in batches:
                for _, vectors in _ints(batch, 0, width, scale):
                    which, _ = held.assign(vectors)
                    for p in range(parts):
                        own = vectors[:, p * size[2] : (p + 1) * size[2]]
                        for k in np.unique(which[:, p]):
                            total[p, k] += own[which[:, p] == k].sum(axis=0)
                            count[p, k] += (which[:, p] == k).sum()
            at = np.nonzero(count)
            if len(at[0]):
                cell = np.repeat(np.ravel_multi_index(at, size[:2]), size[2]) * size[2] + np.tile(np.arange(size[2]), len(at[0]))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell]), pa.array(np.repeat(count[at], size[2]))], ["cell", "total", "n"])

        means = kept.select(vector).mapInArrow(thrifty(sums), "cell long, total long, n long").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        new = held.entries.copy().ravel()
        for r in means.collect():  # parts x entries x components rows at most
            new[r["cell"]] = int(r["total"]) // r["n"]
        books = Books(new.reshape(size))
    return books


def encode(df: DataFrame, books: Books, vector: str, code: str = "code", error: str = "error", scale: int = SCALE) -> DataFrame:
    """The rows of df with finite vectors, with each vector's code (an index by part) and its squared distance in place of the vector."""
    parts, _, place = books.entries.shape
    others = [c for c in df.columns if c != vector]
    names = [*others, code, error]

    def assign(batches):
        for batch in batches:
            for part, vectors in _ints(batch, 0, parts * place, scale):
                which, far = books.assign(vectors)
                codes = pa.FixedSizeListArray.from_arrays(pa.array(which.astype(np.int32).ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], codes, pa.array(far.sum(axis=1))], names)

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != vector)
    return finite(df, vector).select(vector, *[F.col(f"`{c}`") for c in others]).mapInArrow(thrifty(assign), f"{ddl}`{code}` array<int>, `{error}` long")


def decode(df: DataFrame, books: Books, code: str = "code", out: str = "vector", scale: int = SCALE) -> DataFrame:
    """df with the vectors that the codes stand for."""
    whole = F.array(*[F.array(*[F.array(*[F.lit(x / scale) for x in e]) for e in part]) for part in books.entries.tolist()])
    return df.withColumn(out, F.flatten(F.transform(code, lambda c, p: F.get(F.get(whole, p), c))))


def with_group_sum(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """df, a stored table, with the sum of value over equal groups, nulls together."""
    total = F.least(F.sum(F.col(value).cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = df.groupBy(F.col(group).alias("_group")).agg(total.alias(out)).checkpoint()
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return df.join(sums, df[group].eqNullSafe(sums["_group"]), "left").drop("_group")


def query(spark, sf_dir: str) -> DataFrame:
    shared(spark)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = fit(rows, "vec_id", "embedding")
    coded = encode(rows, books, "embedding").checkpoint()
    digits = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    digest = hashlib.sha256(books.text().encode()).hexdigest()
    return with_group_sum(coded, "label", "error", "label_error").select("vec_id", digits.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
