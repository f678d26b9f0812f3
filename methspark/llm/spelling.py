"""Groups of spelling variants: words that one inserted, deleted or replaced letter parts, by a reduced alphabet.

Letters are hashed to a few symbols. The distinct reduced words are few, so each one's whole
neighbourhood of one edit (every deletion, insertion and replacement, and itself, as letters of one symbol
may differ) is generated as hashes; those that are reduced words of the vocabulary, told first by a
broadcast table of bits and then by a join, name the candidates, whose original strings are compared by
their edit distance. The number of symbols is the least for which few words share a reduced word, so
neither neighbourhoods nor candidates grow faster than the vocabulary.

Candidates come from the vocabulary alone; the corpus is read once, and words are counted in each task
before any shuffle. Defined results: null texts have no words and a null id counts as empty; a word near no
other has no form and is its own root; words of equal count and distance go by code-point order; repeated
documents count each time; an empty table gives no row; columns of other names are not read.
"""

from __future__ import annotations

from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import Sieve, shared
from ._text import U, mix, table, thrifty

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Numbers of symbols to choose from; the least is taken at which words share a reduced word with CROWD others at most on average.
SYMBOLS, CROWD = (4, 8, 16, 32, 64), 1.0
BASE, LENGTH = 0xD6E8FEB86659FD93, U(0x9E3779B97F4A7C15)
CELLS = 1 << 18
#: Reduced words whose neighbourhoods one task generates.
WORDS = 1 << 15


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = MIN_LENGTH) -> DataFrame:
    """(key, word) for every run of letters of some length, lower-cased in A-Z alone."""
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    pattern = f"[{LETTERS}]{{{shortest},}}"
    return docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(folded, F.lit(pattern), F.lit(0))).alias("word"))


def slipped(words: DataFrame, every: int = 31) -> DataFrame:
    """(word) with one letter left out of the words whose hash with their key `every` divides, as typing would."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return words.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = MIN_LENGTH, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of some length and number."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, U(base), dtype=U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def reduced(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the words' letters, from 1, one after the other, and the words' ends."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return (mix(letters.astype(U) * U(BASE) + U(1)) >> U(33)) % U(symbols) + U(1), ends


def neighbourhood(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all reduced words at most one edit from each of some reduced words of one length (rows of codes), itself first."""
    n, m = codes.shape
    up = _powers(m + 2, BASE)
    back = U(pow(BASE, -1, 1 << 64))
    at = codes * up[:m]
    before = np.concatenate((np.zeros((n, 1), U), np.cumsum(at, axis=1)), axis=1)  # of the letters before each place
    whole = before[:, -1:]
    after = whole - before
    every = np.arange(1, symbols + 1, dtype=U)
    deleted = before[:, :m] + after[:, 1:] * back
    replaced = (whole - at)[:, :, None] + every * up[:m, None]
    inserted = (before + after * U(BASE))[:, :, None] + every * up[: m + 1, None]
    sizes = (np.full(w.shape[1], k, U) for w, k in ((whole, m), (deleted, max(m - 1, 0)), (replaced.reshape(n, -1), m), (inserted.reshape(n, -1), m + 1)))
    return mix(np.concatenate((whole, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)), axis=1) + np.concatenate(list(sizes)) * LENGTH)


def _by_length(words: list[str], symbols: int, width: int):
    """(indexes, rows of symbols) of words of one length, not many cells at a time; width: cells for a letter."""
    codes, ends = reduced(words, symbols)
    size = np.diff(np.concatenate(([0], ends)))
    for m in np.unique(size):
        own = np.flatnonzero(size == m)
        step = max(1, CELLS // max(1, int(m) * width))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            yield part, codes[(ends[part] - m)[:, None] + np.arange(m)]


def coded(vocab: DataFrame, symbols: int) -> DataFrame:
    """(word, n, reduced): with the hash of the reduced word."""

    def code(batches):
        for batch in batches:
            words, out = batch.column(0).to_pylist(), np.zeros(batch.num_rows, U)
            for own, rows in _by_length(words, symbols, 1):
                m = rows.shape[1]
                out[own] = mix((rows * _powers(m + 1, BASE)[:m]).sum(axis=1, dtype=U) + LENGTH * np.full(len(own), m, U))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.astype(np.int64))], ["word", "n", "reduced"])

    return vocab.select("word", "n").mapInArrow(thrifty(code), "word string, n long, reduced long")


def near(vocab: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all pairs of words of a stored vocabulary that differ by one edit, in both orders."""
    for symbols in SYMBOLS:
        held = coded(vocab, symbols)
        classes = held.groupBy("reduced").agg(F.min("word").alias("word"), F.count("*").alias("k")).checkpoint()
        words, met = classes.agg(F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum(F.col("k") * (F.col("k") - 1)), F.lit(0))).first()
        if met <= CROWD * words:
            break
    held = held.checkpoint()
    # two tables of bits: the second by the hash with its halves exchanged
    turned = F.shiftleft("reduced", 32).bitwiseOR(F.shiftrightunsigned("reduced", 32))
    sieve, other_sieve = Sieve(classes.select("reduced")), Sieve(classes.select(turned))

    def meet(batches):
        for batch in batches:
            own_hash, words = np.array(batch.column(0)), batch.column(1).to_pylist()
            for own, rows in _by_length(words, symbols, 2 * symbols + 1):
                around = neighbourhood(rows, symbols)
                a, b = np.nonzero(sieve.passes(around.ravel()).reshape(around.shape))
                left = around[a, b]
                passed = other_sieve.passes(left << U(32) | left >> U(32))
                a, b = a[passed], b[passed]
                found = np.unique(np.rec.fromarrays((own[a], around[a, b].astype(np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array(own_hash[found["f0"]]), pa.array(found["f1"])], ["reduced", "to"])

    links = classes.select("reduced", "word").repartition(1 + words // WORDS).mapInArrow(thrifty(meet), "reduced long, to long")
    other = held.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("reduced").alias("to"))
    pairs = links.join(other, "to").join(held, "reduced")
    return pairs.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of a vocabulary (word, n).

    n_near: words one edit away; form: the most frequent of them if `ratio` times as frequent; root: the last form of forms."""
    shared(vocab.sparkSession)
    vocab = vocab.checkpoint()
    best = near(vocab).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("w"))).alias("best"))
    known = F.col("best.n") * -1 >= ratio * F.col("n")
    out = vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("best.w")).alias("form"), F.when(known, -F.col("best.n")).alias("form_n")).checkpoint()
    most = out.agg(F.max("n")).first()[0] or 1
    steps, up = 0, out.where("form is not null").select("word", F.col("form").alias("root")).checkpoint()
    while ratio**steps < most:  # a form is at least ratio times as frequent, so chains have this many steps at most
        steps += 1
    for _ in range(int(log2(steps)) + 1 if steps else 0):
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")).checkpoint()
    return out.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(spark, sf_dir: str) -> DataFrame:
    words = slipped(runs(table(spark, sf_dir, "documents")))
    return variants(vocabulary(words)).select("word", "form", "root", "n", "n_near", "form_n")
