"""Language-model scoring with a log-frequency Bloom filter.

Counts of all n-grams (words and pairs by default) of the training texts are merged in hash buckets,
quantised to levels (level j: at least ``floor(GROWTH**(j-1))`` times) and every level up to an
n-gram's own is put into the bucket's segment of a Bloom filter. The segments are broadcast. A count
is read back by probing levels 1, 2, ... until one is missing. Word counts are also kept exactly, for
the add-one baseline: broadcast up to ``MAX_VOCAB`` words, joined in buckets beyond.

The model: P(w) = (low(w)+1) / (N+V+1); P(w|h) = (low(hw) + T(h)*P(w)) / (high(h)+T(h)), with counts
rounded down on top and up below, so the probabilities of all words sum to at most one but for false
positives. T(h) estimates how many different words follow h: high(h)**beta, with beta such that the sum
over all words is the number of different pairs in training.

When the filter would exceed ``MAX_FILTER_BYTES``, its segments are broadcast in groups, one pass over the
texts each, which notes the levels found beside the text; no n-gram is left out, whatever the order.

Defined results: null and empty texts hold the end token alone; an empty training set gives N = 0 and
V = 0; repeated rows are scored (and counted) each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import placed, shared
from ._text import SPACED, U, chunks, mix, table, thrifty

ORDER = 2
BITS_PER_ENTRY = 8
PROBES = 5
GROWTH = 1.2
MAX_FILTER_BYTES = 256 << 20
MAX_VOCAB = 8_000_000
FLUSH = 1_000_000
#: The number of segments doubles with each doubling of the texts beyond so many bytes.
BUCKET_BYTES = 64 << 20
END = mix(np.array([0x656E64], U))[0]
LEVELS = np.unique(np.floor(GROWTH ** np.arange(0, 200)).astype(np.int64))  # 1, 2, 3, 5, 7, ...
MULTIPLIER = U(0xC2B2AE3D27D4EB4F)


def tokens(words, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with the end token after each text, and each token's text."""
    h = np.empty(len(words.hash) + n_docs, U)
    doc = np.repeat(np.arange(n_docs), words.count + 1)
    last = np.cumsum(words.count + 1) - 1
    inside = np.ones(len(h), bool)
    inside[last] = False
    h[last], h[inside] = END, words.hash
    return h, doc


def ngrams(h: np.ndarray, doc: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1- to order-grams that end at each token; before a text stand end tokens."""
    out, history = [h], h
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.empty(0, bool)
    back, begin = h, first
    for n in range(2, order + 1):
        back = np.concatenate(([END], back[:-1]))[: len(h)]
        back = np.where(begin, END, back)
        begin = first | np.concatenate(([True], begin[:-1]))[: len(h)]
        history = mix(history * MULTIPLIER + back + U(n))
        out.append(history)
    return out


def _counts(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, c = (np.concatenate(x) for x in zip(*pieces, strict=True))
    order = np.argsort(h)
    h, c = h[order], c[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
    return h[at], np.add.reduceat(c, at) if len(at) else c


def count_ngrams(docs: DataFrame, text_col: str, order: int, buckets: int) -> DataFrame:
    """(kind, bucket, hashes, counts): n-gram counts, merged in each task before they are dealt out."""

    def run(batches):
        held = {n: [] for n in range(1, order + 1)}
        size = 0

        def flush():
            rows = []
            for n, pieces in held.items():
                if not pieces:
                    continue
                h, c = _counts(pieces)
                cut = np.searchsorted(h, (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(U))
                for b, (x, y) in enumerate(zip(np.split(h, cut), np.split(c, cut), strict=True)):
                    if len(x):
                        rows.append((min(n, 2), b, x.tobytes(), y.astype(np.int64).tobytes()))
                pieces.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["kind", "bucket", "hashes", "counts"])

        for batch in batches:
            for i, j, words in chunks(batch.column(0), SPACED):
                for n, h in enumerate(ngrams(*tokens(words, j - i), order), 1):
                    held[n].append(_counts([(h, np.ones(len(h), np.int64))]))
                    size += len(held[n][-1][0])
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select(text_col).mapInArrow(thrifty(run), "kind int, bucket int, hashes binary, counts binary")


def _pieces(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(a, U), np.frombuffer(b, np.int64)) for a, b in zip(rows["hashes"].to_pylist(), rows["counts"].to_pylist(), strict=True)]


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, side="right")


def _places(h: np.ndarray, level: np.ndarray, k: int, bits: np.ndarray) -> np.ndarray:
    x = mix(h + level.astype(U) * U(0x9E3779B97F4A7C15))
    return (mix(x) + U(k) * (x | U(1))) % bits


def segment(rows: pa.Table, per_entry: float) -> pa.Table:
    """One bucket's filter segment (and, of words, the exact counts)."""
    kind, bucket = rows["kind"][0].as_py(), rows["bucket"][0].as_py()
    h, c = _counts(_pieces(rows))
    level = level_of(c)
    bits = max(64, int(per_entry * int(level.sum())) // 8 * 8 + 8)
    flags = np.zeros(bits, np.uint8)
    for j in range(1, int(level.max()) + 1):
        own = h[level >= j]
        for k in range(PROBES):
            flags[_places(own, np.full(len(own), j), k, U(bits)).astype(np.int64)] = 1
    words = kind == 1
    return pa.table({"kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "filter": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary()), "n": pa.array([len(h)], pa.int64()), "total": pa.array([int(c.sum())], pa.int64()), "levels": pa.array([np.bincount(level, minlength=len(LEVELS) + 1).astype(np.int64).tobytes()], pa.binary()), "hashes": pa.array([h.tobytes() if words else None], pa.binary()), "counts": pa.array([c.tobytes() if words else None], pa.binary())})


SEGMENT = "kind int, bucket int, filter binary, n long, total long, levels binary, hashes binary, counts binary"


class Filter:
    """Segments of a log-frequency Bloom filter, by bucket of the hash."""

    def __init__(self, buckets: int, segments: dict[int, bytes]):
        self.buckets, self.bits, self.base, at, parts = buckets, np.full(buckets, 8, U), np.zeros(buckets, np.int64), 1, [b"\0"]
        self.has = np.zeros(buckets, bool)
        for b, x in sorted(segments.items()):
            self.bits[b], self.base[b], self.has[b] = len(x) * 8, at * 8, True
            parts.append(x)
            at += len(x)
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def bucket(self, h: np.ndarray) -> np.ndarray:
        edges = (np.arange(1, self.buckets, dtype=object) * (1 << 64) // self.buckets).astype(U)
        return np.searchsorted(edges, h, side="right")

    def level(self, h: np.ndarray) -> np.ndarray:
        """The highest level whose probes, and all below, hit."""
        out = np.zeros(len(h), np.int64)
        b = self.bucket(h)
        live = np.flatnonzero(self.has[b])
        j = 1
        while len(live):
            for k in range(PROBES):
                own = b[live]
                at = self.base[own] + _places(h[live], np.full(len(live), j), k, self.bits[own]).astype(np.int64)
                live = live[(self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                if not len(live):
                    break
            out[live] = j
            j += 1
        return out


def bounds(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper end of the counts of these levels."""
    low = np.where(level > 0, LEVELS[np.maximum(level, 1) - 1], 0)
    return low, np.where(level > 0, LEVELS[np.minimum(level, len(LEVELS) - 1)] - 1, 0)


def _sum(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n) if len(doc) else np.zeros(n)


class Model:
    """Sizes of the training set, the exponent of T(h), the level of the end token and the segments' sizes by (kind, bucket)."""

    def __init__(self, buckets: int, order: int, n_tokens: int, n_words: int, beta: float, end_level: int, sizes: list[tuple[tuple[int, int], int]]):
        self.buckets, self.order, self.n_tokens, self.n_words, self.beta, self.end_level, self.sizes = buckets, order, n_tokens, n_words, beta, end_level, sizes


def exponent(words: np.ndarray, pairs: float) -> float:
    """beta with the sum of count**beta over words (numbers of words by level) equal to the number of different pairs."""
    count = LEVELS.astype(float)
    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if (words[1:] * count**mid).sum() < pairs else (low, mid)
    return low


def fit(train: DataFrame, text_col: str = "text", order: int = ORDER, per_entry: float = BITS_PER_ENTRY, buckets: int | None = None):
    """Counts the n-grams and builds the filter; returns (model, stored segments).

    The segments are kept in the shared checkpoint folder, so that a lost executor costs nothing."""
    shared(train.sparkSession)
    if buckets is None:  # by the texts' size, so that segments, and what they tell wrongly, do not depend on how the rows are dealt
        size = train.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
        buckets = 16 << (size // BUCKET_BYTES).bit_length()
    merged = count_ngrams(train, text_col, order, buckets).groupBy("kind", "bucket").applyInArrow(thrifty(lambda t: segment(t, per_entry)), SEGMENT).checkpoint()
    facts = merged.select("kind", "bucket", "n", "total", "levels", F.length("filter").alias("size")).collect()
    word = [r for r in facts if r["kind"] == 1]
    by_level = sum((np.frombuffer(r["levels"], np.int64) for r in word), np.zeros(len(LEVELS) + 1, np.int64))
    grams = sum(r["n"] for r in facts if r["kind"] == 2) / max(1, order - 1)
    end = np.array([END])
    own = int(Filter(buckets, {}).bucket(end)[0])
    end_level = int(_load(merged, [(1, own)], buckets)[0].level(end)[0])
    return Model(buckets, order, sum(r["total"] for r in word), sum(r["n"] for r in word), exponent(by_level, grams), end_level, [((r["kind"], r["bucket"]), r["size"]) for r in facts]), merged


def passes(model: Model, most: int) -> list[list[tuple[int, int]]]:
    """(kind, bucket) of the segments, in groups that fit the broadcast."""
    out, size = [[]], 0
    for b, n in sorted(model.sizes):
        if out[-1] and size + n > most:
            out.append([])
            size = 0
        out[-1].append(b)
        size += n
    return out


def _load(merged: DataFrame, own: list[tuple[int, int]], buckets: int) -> tuple[Filter, Filter]:
    """The filters of words and of longer n-grams, with these segments."""
    chosen = [F.col("bucket").isin([b for k, b in own if k == kind]) & (F.col("kind") == kind) for kind in (1, 2)]
    held: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
    for r in merged.where(chosen[0] | chosen[1]).select("kind", "bucket", "filter").toLocalIterator():
        held[r["kind"]][r["bucket"]] = bytes(r["filter"])
    return Filter(buckets, held[1]), Filter(buckets, held[2])


def probe(filters: tuple[Filter, Filter], hashes: list[np.ndarray]) -> np.ndarray:
    """The level of each n-gram, one row for each order; 0 where its segment is not there."""
    out = np.zeros((len(hashes), len(hashes[0])), np.uint8)
    for k, h in enumerate(hashes):
        u, back = np.unique(h, return_inverse=True)
        out[k] = filters[min(k, 1)].level(u)[back]
    return out


def log_probabilities(model: Model, levels: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """log10 P of each token by the interpolated model, from the levels of the n-grams that end at it."""
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.empty(0, bool)
    low, high = bounds(levels[0].astype(np.int64))
    p = (low + 1) / (model.n_tokens + model.n_words + 1)
    at_start = bounds(np.array([model.end_level]))[1][0]  # a text's first token follows an end
    for k in range(1, model.order):
        above = np.where(first, at_start if k == 1 else 0, np.concatenate(([0], high[:-1])))
        low, high = bounds(levels[k].astype(np.int64))
        kinds = np.maximum(above, 1.0) ** model.beta
        p = (np.minimum(low, above) + kinds * p) / (above + kinds)
    return np.log10(p)


FIELDS = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, merged: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter: int = MAX_FILTER_BYTES, max_vocab: int = MAX_VOCAB) -> DataFrame:
    """id, n_tokens, n_known, base_score, score (log10), one row for each document."""
    spark, n_all, v, order = docs.sparkSession, model.n_tokens, model.n_words, model.order
    kind = docs.schema[id_col].dataType.simpleString()
    exact = None
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(None).cast("binary").alias("levels"))
    if v <= max_vocab:
        rows = merged.where("kind = 1").orderBy("bucket").select("hashes", "counts").toLocalIterator()
        pieces = [(np.frombuffer(r[0], U), np.frombuffer(r[1], np.int64)) for r in rows] or [(np.empty(0, U), np.empty(0, np.int64))]
        exact = spark.sparkContext.broadcast(tuple(np.concatenate(x) for x in zip(*pieces, strict=True)))
        own = own.withColumn("row", F.lit(0).cast("long"))
    else:
        own = placed(own, "row")
    groups = passes(model, max_filter)
    for number, group in enumerate(groups):
        filters, last = spark.sparkContext.broadcast(_load(merged, group, model.buckets)), number == len(groups) - 1

        def run(batches, filters=filters, last=last):
            for batch in batches:
                noted = batch.column("levels").to_pylist()
                for i, j, words in chunks(batch.column("text"), SPACED):
                    n = j - i
                    h, doc = tokens(words, n)
                    levels = probe(filters.value, ngrams(h, doc, order))
                    cut = np.concatenate(([0], np.cumsum(words.count + 1)))
                    if noted[i] is not None:
                        for k in range(n):
                            at = slice(cut[k], cut[k + 1])
                            levels[:, at] = np.maximum(levels[:, at], np.frombuffer(noted[i + k], np.uint8).reshape(order, -1))
                    ids, places = batch.column("id").slice(i, n), batch.column("row").slice(i, n)
                    if not last:
                        blobs = [levels[:, a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([ids, places, batch.column("text").slice(i, n), pa.array(blobs, pa.binary())], ["id", "row", "text", "levels"])
                        continue
                    known, base = np.zeros(n), np.zeros(n)
                    if exact is not None:
                        u, back = np.unique(h, return_inverse=True)
                        at = np.searchsorted(exact.value[0], u)
                        at[at == len(exact.value[0])] = 0
                        c = np.where(exact.value[0][at] == u, exact.value[1][at], 0)[back] if len(exact.value[0]) else np.zeros(len(h), np.int64)
                        known, base = _sum((c > 0).astype(float), doc, n), _sum(np.log10((c + 1) / (n_all + v + 1)), doc, n)
                    scores = _sum(log_probabilities(model, levels, doc), doc, n)
                    yield pa.RecordBatch.from_arrays([ids, places, pa.array(words.count + 1, pa.int64()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(scores)], ["id", "row", "n_tokens", "n_known", "base_score", "score"])

        source = own.select("id", "row", "text", "levels")
        if last:
            out = source.mapInArrow(thrifty(run), f"id {kind}, row long, {FIELDS}")
        else:  # stored, so that no task holds the filters of two passes
            own = source.mapInArrow(thrifty(run), f"id {kind}, row long, text string, levels binary").checkpoint()
    if exact is None:
        sums = _base_by_join(own.select("row", "text"), merged, model)
        out = out.drop("n_known", "base_score").join(sums, "row", "left").na.fill({"n_known": 0, "base_score": 0.0})
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", "base_score", "score")


def _base_by_join(own: DataFrame, merged: DataFrame, model: Model) -> DataFrame:
    """The baseline's sums where the vocabulary is too large to broadcast: the distinct words of each
    few megabytes of text meet the exact counts of their bucket, and the sums go back to the texts."""
    buckets, total = model.buckets, model.n_tokens + model.n_words + 1

    def ask(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                h, doc = tokens(words, j - i)
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
                times = np.diff(np.append(at, len(h)))
                rows = np.asarray(batch.column("row").slice(i, j - i).to_pylist())[doc[at]]
                cut = np.searchsorted(h[at], (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(U))
                pieces = [(b, x.tobytes(), y.tobytes(), z.tobytes()) for b, (x, y, z) in enumerate(zip(np.split(h[at], cut), np.split(rows, cut), np.split(times, cut), strict=True)) if len(x)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*pieces, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "hashes", "rows", "times"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        held, counts = _pieces(known)[0] if known.num_rows else (np.empty(0, U), np.empty(0, np.int64))
        rows, found, sums = [], [], []
        for h, r, t in zip(asked["hashes"].to_pylist(), asked["rows"].to_pylist(), asked["times"].to_pylist(), strict=True):
            h, r, t = np.frombuffer(h, U), np.frombuffer(r, np.int64), np.frombuffer(t, np.int64)
            at = np.searchsorted(held, h)
            at[at == len(held)] = 0
            c = np.where(held[at] == h, counts[at], 0) if len(held) else np.zeros(len(h), np.int64)
            u, back = np.unique(r, return_inverse=True)
            rows.append(u)
            found.append(np.bincount(back, t * (c > 0)).astype(np.int64))
            sums.append(np.bincount(back, t * np.log10((c + 1) / total)))
        rows, found, sums = (np.concatenate(x) for x in (rows, found, sums)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"row": rows, "n_known": found, "base_score": sums})

    asked = own.select("text", "row").mapInArrow(thrifty(ask), "bucket int, hashes binary, rows binary, times binary")
    known = merged.where("kind = 1").select("bucket", "hashes", "counts")
    sums = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answer, "row long, n_known long, base_score double")
    return sums.groupBy("row").agg(F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model, merged = fit(docs.where(~held_out))
    out = score(docs, model, merged)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
