"""Lexical retrieval packing of documents into windows of tokens.

Document frequencies and the mean length are counted over all documents. Each document gets a signature:
its heaviest terms by BM25 that another document holds too. Documents are dealt to partitions by the first
of them (by more of them, and by their id, where it is so frequent that a partition would grow), sorted by
signature there and cut into shards of about ``DOCS_PER_SHARD``, so documents with the same heavy terms
stand together. For each shard an inverted index is built with the corpus-wide statistics, and one window
after another is filled: the seed (the lowest unused document in hash order) asks the index with all its
terms, and its unused neighbours follow by falling score until the window is full. What does not fit is
cut and opens the next window, so only a shard's last window has padding. A neighbour in another shard is
not found; the README gives the share.

A task holds one shard at a time, which does not grow with the table; one shuffle moves each text once.
Terms are told apart by 44 bits of a hash. Texts are cut at single spaces between other characters (plain
ones at single line ends, and before one sign that ends a word, too), where the tokenizer's pattern always
splits, and a worker remembers the ids of each distinct piece (by a 64-bit hash), up to a bound: by the same
vocabulary's ranks if its characters are plain, else by the tokenizer file itself.

Defined results: null or empty texts hold the end id alone; a document longer than a window spans
several; repeated rows are packed each; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import shared
from ._text import ALNUM, CHUNK_BYTES, U, buffers, chunks, hash_spans, mix, table, thrifty

WINDOW = 2048
DOCS_PER_SHARD = 1024
END_ID = 1
SIGNATURE = 4
FLUSH = 1_000_000
MAX_VOCABULARY = 8_000_000
K1, B = 1.2, 0.75
SPECIAL = "<|endoftext|>"
PLAIN = re.compile("[\\n -~À-ɏ]*")
CACHE = 1_000_000
JOINED = 8192
SHARD_BYTES = 4 << 20
PARTITION_WORDS = 4_000_000
DENSE = 8
LAST = U((1 << 64) - 1)
LIVE, FEW = 0.8, 64
WORDY, SIGN = np.zeros(256, bool), np.zeros(256, bool)
WORDY[[b for b in range(256) if chr(b).isalnum() and b < 0x80 or b >= 0x80 and b not in (0x97, 0xB7)]] = True  # not the last bytes of the signs \u00d7 and \u00f7
SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_encoders: dict = {}


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of some spans, one after the other."""
    end = np.cumsum(size)
    return np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)


class Encoder:
    """Ids of texts. Each distinct piece of a text is encoded once and remembered, in a table with a slot for each
    hash; beyond CACHE of them, only those that came again since the last time are kept, up to half as many."""

    def __init__(self, file: str, ranks: str | None, pattern: str | None):
        self.file, self.fast = file, None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                held = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=held, special_tokens={})
            self.size = np.zeros(max(held.values()) + 1, np.int64)
            for word, rank in held.items():
                self.size[rank] = len(word)
        self._forget()

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def _forget(self, kept: np.ndarray | None = None, slots: int = 1 << 12) -> None:
        """An empty table, but for the pieces of the slots kept."""
        old = [x[kept] for x in (self.known, self.count, self.start)] if kept is not None and len(kept) else None
        self.known, self.count, self.start, self.again = np.zeros(slots, U), np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, bool)
        self.held = 0
        if kept is None:
            self.pool, self.filled = np.empty(1 << 12, np.uint32), 0
        if old:
            self._put(*old)

    def _rare(self) -> None:
        """Forgets the pieces that did not come again."""
        kept = np.flatnonzero(self.again)[: CACHE // 2]
        size = self.count[kept]
        pool = self.pool[spread(self.start[kept], size)]
        self.start[kept] = np.cumsum(size) - size
        self._forget(kept)
        self.pool, self.filled = pool, len(pool)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash: its own, or else the free one that its search ends at."""
        last = len(self.known) - 1
        at = (h & U(last)).view(np.int64)
        found = self.known[at]
        more = np.flatnonzero((found != h) & (found != 0))
        while len(more):
            at[more] = (at[more] + 1) & last
            found = self.known[at[more]]
            more = more[(found != h[more]) & (found != 0)]
        return at

    def _put(self, h: np.ndarray, count: np.ndarray, start: np.ndarray) -> None:
        """Adds distinct hashes that the table lacks."""
        if 2 * (self.held + len(h)) > len(self.known):
            again = self.known[self.again]
            self._forget(np.flatnonzero(self.known), 1 << (3 * (self.held + len(h))).bit_length())
            self.again[self._find(again)] = True
        left = np.arange(len(h))
        while len(left):
            at = self._find(h[left])
            self.known[at] = h[left]
            own = self.known[at] == h[left]  # of those that meet at a free slot, one gets it
            self.count[at[own]], self.start[at[own]] = count[left[own]], start[left[own]]
            left = left[~own]
        self.held += len(h)

    def plain(self, text: str) -> bool:
        return self.fast is not None and PLAIN.fullmatch(text) is not None and SPECIAL not in text

    def piece(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text) if self.plain(text) else self.whole.encode(text, add_special_tokens=False).ids

    def _learn(self, raw: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray, joins: np.ndarray) -> None:
        """Encodes new pieces; those that can follow each other (a space before, none at the end) some thousands in one text, which is cut again by the tokens' sizes."""
        size, counts, out = e - s, np.zeros(len(h), np.int64), [np.empty(0, np.uint32)]
        many, rest, done = np.flatnonzero(joins), np.flatnonzero(~joins), []
        for own in np.split(many, range(JOINED, len(many), JOINED)):
            ends = np.cumsum(size[own])
            ids = np.array(self.fast.encode_ordinary(raw[spread(s[own], size[own])].tobytes().decode()), np.uint32) if len(own) else np.empty(0, np.uint32)
            told = np.cumsum(self.size[ids]) if len(own) else ends
            cut = np.minimum(np.searchsorted(told, ends), len(told) - 1)
            if (told[cut] == ends).all():
                counts[own] = np.diff(np.concatenate(([-1], cut)))
                out.append(ids)
                done.append(own)
            else:
                rest = np.concatenate((rest, own))
        for k in rest.tolist():
            ids = np.array(self.piece(raw[s[k] : e[k]].tobytes().decode()), np.uint32)
            counts[k] = len(ids)
            out.append(ids)
        order, new = np.concatenate((*done, rest)), np.concatenate(out)
        starts = np.empty(len(h), np.int64)
        starts[order] = self.filled + np.cumsum(counts[order]) - counts[order]
        if self.filled + len(new) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.filled], np.empty(len(new) + self.filled // 2, np.uint32)))
        self.pool[self.filled : self.filled + len(new)] = new
        self.filled += len(new)
        self._put(h, counts, starts)

    def ids(self, raw: np.ndarray, offsets: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """As batch(), of about a megabyte of whole texts at a time."""
        parts, totals, i, n = [], [np.zeros(1, np.int64)], 0, len(offsets) - 1
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1))
            tokens, at = self.batch(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            parts.append(tokens)
            totals.append(totals[-1][-1] + at[1:])
            i = j
        return np.concatenate(parts) if parts else np.empty(0, np.uint32), np.concatenate(totals)

    def batch(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, the end id after each, and their offsets."""
        n = len(offsets) - 1
        texts = [raw[a:b].tobytes().decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        plain = np.array([self.plain(t) for t in texts], bool)
        doc_plain = np.repeat(plain, np.diff(offsets))
        solid = (raw > 0x20) & ((raw < 0x7F) | doc_plain)  # surely no white space
        cut = (raw == 0x20) | ((raw == 0x0A) & doc_plain)
        cut[1:] &= solid[:-1]
        cut[:-1] &= solid[1:]
        if len(cut):
            cut[-1] = False
            starts = offsets[:-1][np.diff(offsets) > 0]
            ends = offsets[1:][np.diff(offsets) > 0]
            cut[ends - 1] = False  # a last space is not followed by its text's character
            begin = cut.copy()
            after = np.flatnonzero(cut & doc_plain)
            begin[after[SIGN[raw[after - 1]] & WORDY[raw[after - 2]]] - 1] = True
            begin[starts] = True
        else:
            begin = cut
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(raw))
        h = np.maximum(hash_spans(raw, s, e), U(1))  # 0 is a free slot
        if self.held > CACHE:
            self._rare()
        at = self._find(h)
        new = self.known[at] != h
        self.again[at[~new]] = True
        if new.any():
            u, first = np.unique(h[new], return_index=True)
            where = np.flatnonzero(new)[first]
            joins = cut[s[where]] & solid[e[where] - 1] if self.fast else np.zeros(len(where), bool)
            if self.fast and not plain.all():
                lone = ~((raw == 0x0A) | ((raw >= 0x20) & (raw < 0x7F)) | doc_plain) | ((raw == ord("<")) & ~doc_plain)  # the latter may begin the special token
                joins &= ~np.logical_or.reduceat(lone, s)[where]
            slots = len(self.known)
            self._learn(raw, u, s[where], e[where], joins)
            if len(self.known) > slots:
                at = self._find(h)
            else:
                at[new] = self._find(h[new])
        count, start = self.count[at], self.start[at]
        told = np.concatenate(([0], np.cumsum(count)))
        total = told[np.searchsorted(s, offsets)] + np.arange(n + 1)
        out = np.full(total[-1], END_ID, np.uint32)
        inside = np.ones(total[-1], bool)
        inside[total[1:] - 1] = False
        out[inside] = self.pool[spread(start, count)]
        return out, total


def encoder(file: str, ranks: str | None, pattern: str | None) -> Encoder:
    key = (file, ranks)
    if key not in _encoders:
        _encoders[key] = Encoder(file, ranks, pattern)
    return _encoders[key]


def doc_terms(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct terms, by text and term: the text, the term (44 bits), its occurrences. At most 2**20 texts."""
    key = np.sort((words.doc.astype(U) << U(44)) | (words.hash >> U(20)))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]
    return (key[at] >> U(44)).astype(np.int64), key[at] & U((1 << 44) - 1), np.diff(np.append(at, len(key)))


def weights(df: np.ndarray, tf: np.ndarray, length: np.ndarray, n_docs: int, mean: float) -> np.ndarray:
    """BM25 weights of terms by their documents of n_docs and their occurrences in texts of these lengths."""
    return np.log1p((n_docs - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(1.0, mean)))


def in_order(term: np.ndarray) -> np.ndarray:
    """Places of terms of 44 bits by term, equal ones as they stand."""
    if len(term) >> 20:
        return np.argsort(term, kind="stable")
    return (np.sort((term << U(20)) | np.arange(len(term), dtype=U)) & U((1 << 20) - 1)).view(np.int64)


class BM25:
    """Inverted index of one shard's texts, weighted by the whole corpus; documents that are used leave the results,
    and the index once they are many.

    The lists of terms that more than one in DENSE texts holds are kept as rows of a matrix; terms of one text have none."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, lengths: np.ndarray, corpus_df: np.ndarray, n_docs: int, mean: float):
        n = len(lengths)
        order = in_order(term)
        by = term[order]
        first = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))[: len(by)]
        size = np.diff(np.append(first, len(by)))
        several = size > 1
        of = np.full(len(term), -1)
        of[order] = np.repeat(np.where(several, np.cumsum(several) - 1, -1), size)
        order = order[np.repeat(several, size)]
        df = size[several]
        shared_by = np.flatnonzero(of >= 0)
        self.doc_terms, self.query_start = of[shared_by], np.searchsorted(doc[shared_by], np.arange(n + 1))
        often = np.flatnonzero(df * DENSE > n)
        self.row = np.full(len(df), -1)
        self.row[often] = np.arange(len(often))
        self.post_doc, self.post_weight = doc[order], weights(corpus_df[order], tf[order], lengths[doc[order]], n_docs, mean)
        row = np.repeat(self.row, df)
        self.matrix = np.zeros((len(often), n))
        self.matrix[row[row >= 0], self.post_doc[row >= 0]] = self.post_weight[row >= 0]
        self.post_doc, self.post_weight, df[often] = self.post_doc[row < 0], self.post_weight[row < 0], 0
        self.post_start = np.concatenate(([0], np.cumsum(df)))
        self.docs = np.arange(n)

    def _leave(self, used: np.ndarray) -> None:
        """Takes the used documents out of the lists, if they are many."""
        keep = ~used[self.docs]
        left = int(keep.sum())
        if left > LIVE * len(keep) or left < FEW:
            return
        self.docs, self.matrix = self.docs[keep], self.matrix.compress(keep, axis=1)
        own, place = keep[self.post_doc], np.cumsum(keep) - 1
        self.post_start = np.concatenate(([0], np.cumsum(own)))[self.post_start]
        self.post_doc, self.post_weight = place[self.post_doc[own]], self.post_weight[own]

    def nearest(self, seed: int, used: np.ndarray):
        """Unused documents that share a term with the seed, best first, ties in order, each found as it is asked for."""
        self._leave(used)
        docs, terms = self.docs, self.doc_terms[self.query_start[seed] : self.query_start[seed + 1]]
        rows = self.row[terms]
        score = self.matrix.take(rows[rows >= 0], axis=0).sum(0)
        terms = terms[rows < 0]
        lo = self.post_start[terms]
        at = spread(lo, self.post_start[terms + 1] - lo)
        if len(at):
            score += np.bincount(self.post_doc[at], self.post_weight[at], len(docs))
        score[used[docs] | (docs == seed)] = 0
        while len(docs):
            k = int(score.argmax())
            if not score[k]:
                return
            score[k] = 0
            yield int(docs[k])

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """All of them."""
        return np.fromiter(self.nearest(seed, used), np.int64)


def fill(index: BM25, lengths: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces: each window takes its seed, then the seed's neighbours."""
    used, out = np.zeros(len(lengths), bool), []
    sequence, offset, seed, queue = 0, 0, 0, iter(())
    doc, start = -1, 0
    while True:
        if doc < 0:
            doc = next((d for d in queue if not used[d]), -1)
            if doc < 0:
                while seed < len(lengths) and used[seed]:
                    seed += 1
                if seed == len(lengths):
                    return out
                doc = seed
                queue = index.nearest(doc, used)
            used[doc], start = True, 0
        take = min(int(lengths[doc]) - start, window - offset)
        out.append((doc, start, take, sequence, offset))
        start, offset = start + take, offset + take
        if offset == window:
            sequence, offset = sequence + 1, 0
            queue = index.nearest(doc, used) if start < lengths[doc] else iter(())
        if start == lengths[doc]:
            doc = -1


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms, in order, and their summed counts."""
    term, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    return term, np.bincount(at, np.concatenate([c for _, c in parts]), len(term)).astype(np.int64)


def vocabulary(own: DataFrame) -> tuple[DataFrame, int, int]:
    """(bucket, terms, counts) of the terms that several documents hold, by bucket of the hash, checkpointed; the documents and words of all."""
    buckets = 16 << max(0, (own.rdd.getNumPartitions() // 8).bit_length())

    def scan(batches):
        held, docs, n_words = [(np.empty(0, U), np.empty(0, np.int64))], 0, 0

        def flush():
            term, count = summed(held)
            bucket = (term >> U(8)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            at = [(k, order[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a or not k]
            return pa.RecordBatch.from_pydict({"bucket": pa.array([k for k, _ in at], pa.int32()), "terms": pa.array([term[x].tobytes() for _, x in at], pa.binary()), "counts": pa.array([count[x].tobytes() for _, x in at], pa.binary()), "docs": pa.array([0 if k else docs for k, _ in at], pa.int64()), "words": pa.array([0 if k else n_words for k, _ in at], pa.int64())})

        for batch in batches:
            for i, j, words in chunks(batch.column("text"), ALNUM):
                key = np.sort(((words.hash >> U(20)) << U(20)) | words.doc.astype(U))
                term = key[np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]] >> U(20)
                at = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))[: len(term)]
                held.append((term[at], np.diff(np.append(at, len(term)))))
                docs, n_words = docs + j - i, n_words + len(words.hash)
                if sum(len(t) for t, _ in held) > FLUSH:
                    held = [summed(held)]
                    if len(held[0][0]) > FLUSH // 2:
                        yield flush()
                        held, docs, n_words = [(np.empty(0, U), np.empty(0, np.int64))], 0, 0
        yield flush()

    def add(rows: pa.Table) -> pa.Table:
        term, count = summed([(np.frombuffer(t, U), np.frombuffer(c, np.int64)) for t, c in zip(rows["terms"].to_pylist(), rows["counts"].to_pylist(), strict=True)])
        keep = count > 1
        return pa.table({"bucket": rows["bucket"].slice(0, 1), "terms": pa.array([term[keep].tobytes()], pa.binary()), "counts": pa.array([count[keep].tobytes()], pa.binary()), "docs": pa.array([sum(rows["docs"].to_pylist())], pa.int64()), "words": pa.array([sum(rows["words"].to_pylist())], pa.int64())})

    schema = "bucket int, terms binary, counts binary, docs long, words long"
    found = own.select("text").mapInArrow(thrifty(scan), schema).groupBy("bucket").applyInArrow(thrifty(add), schema).checkpoint()
    total = found.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    return found.select("bucket", "terms", "counts"), total["docs"], total["words"]


def finder(known: np.ndarray):
    """A function of terms of 44 bits that gives the first place of known, in order and with a last value beyond all terms, that is not below each."""
    bits = (len(known) // 4).bit_length()
    shift = U(44 - bits)
    begin = np.searchsorted(known, np.arange(1 << bits, dtype=U) << shift).astype(np.int32)

    def find(term: np.ndarray) -> np.ndarray:
        at = begin[(term >> shift).view(np.int64)].astype(np.int64)
        more = np.flatnonzero(known[at] < term)
        while len(more):
            at[more] += 1
            more = more[known[at[more]] < term[more]]
        return at

    return find


def segments(found: DataFrame, most: int):
    """Broadcasts of (terms, counts), in order of the terms and with a last term beyond all, of at most about `most` terms each; one at least."""
    sizes = sorted((r["bucket"], r["n"]) for r in found.select("bucket", (F.length("terms") / 8).cast("long").alias("n")).collect())
    groups, size = [[]], 0
    for bucket, n in sizes:
        if groups[-1] and size + n > most:
            groups, size = [*groups, []], 0
        groups[-1].append(bucket)
        size += n
    for own in groups:
        parts = [(np.frombuffer(r["terms"], U), np.frombuffer(r["counts"], np.int64)) for r in found.where(F.col("bucket").isin(own)).toLocalIterator()]
        yield found.sparkSession.sparkContext.broadcast(summed([*parts, (np.array([LAST]), np.zeros(1, np.int64))]))


def signed(own: DataFrame, kind: str, max_vocabulary: int, docs_per_shard: int, partition_words: int) -> tuple[DataFrame, int, float, int]:
    """id, text, dfs (documents of each of its terms, in order of the term), s0, s1, ... (its signature) and part; the documents, the mean length and the number of partitions.

    Each segment of the vocabulary is one pass over the texts, which fills in the terms it holds."""
    found, n_docs, n_words = vocabulary(own)
    mean, parts = n_words / max(1, n_docs), 1 + n_words // partition_words
    limit = max(docs_per_shard, n_docs // (4 * parts))
    marks = [f"s{k}" for k in range(SIGNATURE)]
    out, held_all = own.select("id", "text", F.xxhash64("id").alias("salt"), F.lit(None).cast("binary").alias("dfs")), list(segments(found, max_vocabulary))
    for number, held in enumerate(held_all):

        def look(batches, held=held):
            known, counts = held.value
            find = finder(known)
            for batch in batches:
                before, salts = batch.column("dfs").to_pylist(), np.array(batch.column("salt"))
                for i, j, words in chunks(batch.column("text"), ALNUM):
                    doc, term, tf = doc_terms(words)
                    at = find(term)
                    df = np.where(known[at] == term, counts[at], 1)
                    if before[i] is not None:
                        df = np.maximum(df, np.frombuffer(b"".join(before[i:j]), np.uint32))
                    weight = np.where(df > 1, weights(df, tf, words.count[doc], n_docs, mean), -1.0)
                    cut = np.searchsorted(doc, np.arange(j - i + 1))
                    sign, often = np.zeros((SIGNATURE, j - i), np.int64), np.zeros((SIGNATURE, j - i), np.int64)
                    has = np.flatnonzero(cut[:-1] < cut[1:])
                    for k in range(SIGNATURE if len(has) else 0):
                        best = np.maximum.reduceat(weight, cut[has])
                        first = np.flatnonzero(weight == np.repeat(best, np.diff(cut)[has]))
                        first = first[np.concatenate(([True], doc[first][1:] != doc[first][:-1]))]
                        first = first[weight[first] > 0]
                        sign[k, doc[first]], often[k, doc[first]] = term[first].view(np.int64), df[first]
                        weight[first] = -1.0
                    # a first term of too many documents is divided by the whole signature, and that by the id
                    wide = -(-np.where(sign[0] != 0, often[0], n_docs) // limit)
                    alike = -(-np.where(sign[-1] != 0, often.min(0), np.where(sign[0] != 0, often[0], n_docs)) // limit)
                    whole = mix(sign.astype(U).T @ (np.arange(SIGNATURE).astype(U) * U(2654435762) + U(1)))
                    part = mix(sign[0].astype(U) + whole % wide.astype(U) * U(0x9E3779B97F4A7C15)) + mix(salts[i:j].astype(U)) % alike.astype(U)
                    data = df.astype(np.uint32)
                    dfs = pa.array([data[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), batch.column("text").slice(i, j - i), batch.column("salt").slice(i, j - i), dfs, *map(pa.array, sign), pa.array(part.view(np.int64))], ["id", "text", "salt", "dfs", *marks, "part"])

        out = out.select("id", "text", "salt", "dfs").mapInArrow(thrifty(look), f"id {kind}, text string, salt long, dfs binary, " + ", ".join(f"{m} long" for m in marks) + ", part long")
        if number < len(held_all) - 1:
            out = out.checkpoint()
    return out, n_docs, mean, parts


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, window: int = WINDOW, docs_per_shard: int = DOCS_PER_SHARD, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, max_vocabulary: int = MAX_VOCABULARY, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """One row for each piece; ``with_ids`` adds the piece's token ids."""
    shared(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    own, n_docs, mean, parts = signed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), kind, max_vocabulary, docs_per_shard, partition_words)
    marks = [f"s{k}" for k in range(SIGNATURE)]
    own = own.repartition(parts, "part").sortWithinPartitions(*marks, F.xxhash64("text"), "salt").select("id", "text", "dfs")

    def shards(batches):
        """Tables of at most docs_per_shard rows and, but for a single long one, SHARD_BYTES of text."""
        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            _, offsets = buffers(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                end = min(batch.num_rows, at + docs_per_shard - rows)
                end = min(end, max(at + (not rows), int(np.searchsorted(offsets, offsets[at] + SHARD_BYTES - size, side="right")) - 1))
                if end > at:
                    held.append(batch.slice(at, end - at))
                    rows, size, at = rows + end - at, size + int(offsets[end] - offsets[at]), end
                if at < batch.num_rows:
                    yield pa.Table.from_batches(held)
                    held, rows, size = [], 0, 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        from pyspark import TaskContext

        sequence, enc = TaskContext.get().partitionId() << 32, encoder(tokenizer, ranks, pattern)
        for rows in shards(batches):
            dfs = rows["dfs"].to_pylist()
            raw, offsets = buffers(rows["text"])
            order = sorted(range(rows.num_rows), key=lambda k: zlib.crc32(raw[offsets[k] : offsets[k + 1]]))
            rows = rows.take(pa.array(order))
            doc, term, tf, counts = [], [], [], []
            for i, _, words in chunks(rows["text"], ALNUM):
                for x, y in zip((doc, term, tf, counts), (*doc_terms(words), words.count), strict=True):
                    x.append(y + i if x is doc else y)
            doc, term, tf, counts = (np.concatenate(x) for x in (doc, term, tf, counts))
            tokens, at = enc.ids(*buffers(rows["text"]))
            index = BM25(doc, term, tf, counts, np.frombuffer(b"".join(dfs[k] for k in order), np.uint32).astype(np.int64), n_docs, mean)
            lengths = np.diff(at)
            doc, start, length, seq, offset = (np.array(x) for x in zip(*fill(index, lengths, window), strict=True))
            parts = [tokens[a : a + n] for a, n in zip((at[doc] + start).tolist(), length.tolist(), strict=True)]
            out = {"id": rows["id"].take(pa.array(doc)), "start": start, "length": length, "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()), "doc_tokens": lengths[doc], "sequence_id": sequence + seq, "offset": offset}
            yield from pa.table(out | ({"ids": pa.array(parts, pa.list_(pa.int32()))} if with_ids else {})).to_batches()
            sequence += int(seq.max()) + 1

    out = own.mapInArrow(thrifty(run), f"id {kind}, {PIECE}" + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("id", id_col)


def public_files() -> tuple[str, str, str]:
    """Tokenizer file, the same vocabulary's ranks, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), *public_files())
