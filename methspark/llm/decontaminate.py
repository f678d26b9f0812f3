"""Benchmark decontamination by a broadcast hash set of normalised test windows.

Test items are lower-cased (A-Z), cut into words of digits, a-z and non-ASCII characters, and into
windows of ``window`` words (a shorter item is one window). The windows' hashes are broadcast, in
blocks whose size is checked; training texts are scanned once per block, every hash hit is verified
against the words themselves, and hit words are removed as spans or with their whole document.
A block holds up to ``MAX_WINDOWS`` words, but for a single item that has more. One block marks the texts
on their way and shuffles nothing. Of several, each is a job of its own, so a worker holds one at a time;
it stores the marks of the texts that it hits by their place, and these, broadcast if they are few, are joined to
the texts.

Defined results: null or empty text has no words and no hit; null or empty items have no window; a null
item id counts as the empty text; repeated items each count; repeated documents each keep their row; other
columns are untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import free, placed
from ._text import ALNUM, chunks, runs, table, thrifty, words_of

WINDOW = 10
MAX_WINDOWS = 1_000_000
BITS = 20
#: Marks of several blocks that are sent to every executor; more are joined by place.
BROADCAST_BYTES = 32 << 20


class WindowSet:
    """Hashes, words and items of the windows of some test items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.entries: dict[int, dict[int, list[tuple[bytes, set[str]]]]] = {}
        for item, text in items:
            w = words_of(text, ALNUM)
            n = min(window, len(w.hash))
            if not n:
                continue
            at, hashes = w.windows(n)
            own = self.entries.setdefault(n, {})
            for i, h in zip(at.tolist(), hashes.tolist(), strict=True):
                words, held = w.joined(i, n), own.setdefault(h, [])
                match = next((x for x in held if x[0] == words), None)
                (match[1].add(item)) if match else held.append((words, {item}))
        self.sorted = {n: np.array(sorted(x), np.uint64) for n, x in self.entries.items()}
        self.maybe = {}
        for n, hashes in self.sorted.items():
            self.maybe[n] = np.zeros(1 << BITS, bool)
            self.maybe[n][(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def scan(self, words) -> tuple[np.ndarray, list[set[str]]]:
        """Hit flags by word, and the items that occur in each text."""
        hit, items = np.zeros(len(words.hash), bool), [set() for _ in range(len(words.count))]
        for n, known in self.sorted.items():
            at, hashes = words.windows(n)
            keep = np.flatnonzero(self.maybe[n][(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
            keep = keep[np.isin(hashes[keep], known)] if len(keep) else keep
            for i, h in zip(at[keep].tolist(), hashes[keep].tolist(), strict=True):
                text = words.joined(i, n)
                for own, ids in self.entries[n][h]:
                    if own == text:
                        hit[i : i + n] = True
                        items[words.doc[i]] |= ids
        return hit, items


def window_blocks(items: DataFrame, window: int, item_col: str, text_col: str, max_windows: int) -> list[Callable]:
    """What makes each broadcast window set, each from items of at most about ``max_windows`` words together."""
    spark = items.sparkSession
    items = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = 1 + size // (2 * max_windows)  # a word has two characters at least, its separator included

    def block(k: int):
        own = items if n_blocks == 1 else items.where(F.expr(f"pmod(xxhash64(item, text), {n_blocks}) = {k}"))
        return spark.sparkContext.broadcast(WindowSet([(r["item"], r["text"]) for r in own.toLocalIterator()], window))

    return [partial(block, k) for k in range(n_blocks)]


def _found(batches, text: int, held) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, list]]:
    """Each batch with its texts' numbers of words, hit words and items."""
    for batch in batches:
        hits, known, n_words = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)], np.zeros(batch.num_rows, np.int64)
        for i, j, words in chunks(batch.column(text), ALNUM):
            hit, found = held.value.scan(words)
            n_words[i:j] = words.count
            for k in (k for k, x in enumerate(found) if x):
                hits[i + k] = np.flatnonzero(hit[words.first[k] : words.first[k + 1]]).astype(np.int32)
                known[i + k] = sorted(found[k])
        yield batch, n_words, hits, known


def _marked(docs: DataFrame, items: DataFrame, window: int, text_col: str, item_col: str, item_text_col: str, max_windows: int) -> tuple[DataFrame, str, str, str]:
    """docs with three columns, whose names are free: the hit words of each text, the items found and the number of words."""
    marks, names, sizes = free(docs.columns, "hit_words", "found_items", "n_words")
    added = f"`{marks}` array<int>, `{names}` array<string>"
    blocks = window_blocks(items, window, item_col, item_text_col, max_windows)
    columns, at = docs.columns, docs.columns.index(text_col)
    if len(blocks) == 1:
        held = blocks[0]()

        def mark(batches):
            for batch, n_words, hits, known in _found(batches, at, held):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.int32())), pa.array(known, pa.list_(pa.string())), pa.array(n_words)], [*columns, marks, names, sizes])

        return docs.mapInArrow(thrifty(mark), f"{_ddl(docs)}{added}, `{sizes}` long"), marks, names, sizes
    (place,) = free([*docs.columns, marks, names, sizes], "place")
    docs = placed(docs, place)
    parts = []
    for block in blocks:
        held = block()

        def look(batches, held=held):
            for batch, _, hits, known in _found(batches, 1, held):
                own = [k for k, x in enumerate(known) if x]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array([hits[k] for k in own], pa.list_(pa.int32())), pa.array([known[k] for k in own], pa.list_(pa.string()))], [place, marks, names])

        parts.append(docs.select(place, text_col).mapInArrow(thrifty(look), f"`{place}` long, {added}").checkpoint())
        held.unpersist()
    every = lambda c, kind: F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), F.expr(f"cast(array() as array<{kind}>)")).alias(c)
    found = reduce(DataFrame.unionAll, parts).groupBy(place).agg(every(marks, "int"), every(names, "string")).checkpoint()
    size = found.agg(F.coalesce(F.sum(16 + 4 * F.size(marks) + 64 * F.size(names)), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)

    def count(batches):
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            for i, j, words in chunks(batch.column(at), ALNUM):
                n_words[i:j] = words.count
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words)], [*columns, place, sizes])

    sized = docs.mapInArrow(thrifty(count), f"{_ddl(docs)}`{sizes}` long").join(found, place, "left").drop(place)
    none = {c: F.coalesce(F.col(c), F.expr(f"cast(array() as array<{kind}>)")) for c, kind in ((marks, "int"), (names, "string"))}
    return sized.withColumns(none).select(*[F.col(f"`{c}`") for c in (*columns, marks, names, sizes)]), marks, names, sizes


def _ddl(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: id, n_words, hits (runs of hit words, [start, end) in words), items (those found)."""
    kind = docs.schema[id_col].dataType.simpleString()
    marked, marks, names, sizes = _marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items, window, "text", item_col, item_text_col, max_windows)

    def report(batches):
        for batch in batches:
            hits = []
            for x in batch.column(marks).to_pylist():
                x = np.array(x, np.int64)
                cut = np.flatnonzero(np.diff(x) > 1) + 1
                hits.append([{"start": int(p[0]), "end": int(p[-1]) + 1} for p in np.split(x, cut)] if len(x) else [])
            hits = pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column(sizes), hits, batch.column(names)], ["id", "n_words", "hits", "items"])

    out = marked.drop("text").mapInArrow(thrifty(report), f"id {kind}, n_words long, hits array<struct<start:int,end:int>>, items array<string>")
    return out.withColumnRenamed("id", id_col)


def remove_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", whole_documents: bool = False, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents with every hit word cut out of the text, or without the documents that have one.

    All columns are kept as they are; a text without a hit is returned byte for byte. Hits of all blocks of
    test items are words of the text as given and are cut at once, so the result does not depend on the blocks.
    """
    marked, marks, names, sizes = _marked(docs, items, window, text_col, item_col, item_text_col, max_windows)

    def clean(batches):
        for batch in batches:
            hits, column = batch.column(marks).to_pylist(), batch.schema.get_field_index(text_col)
            batch = batch.drop_columns([marks, names, sizes])
            if whole_documents:
                yield batch.filter(pa.array([not x for x in hits], pa.bool_()))
                continue
            own = [n for n, x in enumerate(hits) if x]
            if own:
                texts = {}
                for i, j, words in chunks(batch.column(column).take(pa.array(own, pa.int64())), ALNUM):
                    for k in range(j - i):
                        first, flags = words.first[k], np.zeros(words.count[k], bool)
                        flags[hits[own[i + k]]] = True
                        s, e = runs(flags)
                        at, kept = words.offsets[k], []
                        for x, y in zip(words.starts[first + s].tolist(), words.ends[first + e - 1].tolist(), strict=True):
                            kept.append(words.raw[at:x].tobytes())
                            at = y
                        texts[own[i + k]] = b"".join([*kept, words.raw[at : words.offsets[k + 1]].tobytes()]).decode()
                values = batch.column(column).to_pylist()
                for n, v in texts.items():
                    values[n] = v
                batch = batch.set_column(column, batch.schema.field(column), pa.array(values, batch.schema.field(column).type))
            yield batch

    return marked.mapInArrow(thrifty(clean), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
