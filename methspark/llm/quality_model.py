"""Weak-label quality model: EM over overlapping heuristic labellers, then a hashed linear scorer.

Every labeller votes good, bad or abstains on each whole text. Expectation-maximisation over the
counts of vote patterns (a bounded table, gathered from all documents) estimates each labeller's
accuracy; the posterior of the patterns then labels a sample of at most ``TRAIN_ROWS`` documents on
which a logistic scorer over hashed words is trained, in tasks of some ``SHARD_ROWS`` rows whose weights are averaged.
Two such models are fitted, one for well-formedness and one for toxicity. The keyword and stem lists
of two toxicity labellers come from at most ``LABELLED_ROWS`` rows of a table of labels.

Defined results: null and empty texts get abstentions alone, so the prior decides, nearly
alone where words are few; repeated rows are judged alike; without labels the learned lists are empty; a model whose
labellers vote for one side alone is not fitted, and takes them as first thought; a document whose labels disagree counts
as toxic; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import SPACED, U, chunks, hash_spans, mix, table, thrifty, words_of

TRAIN_ROWS = 16_384
LABELLED_ROWS = 20_000
SHARD_ROWS = 2048
DIMS = 1 << 16
EPOCHS = 5
MIN_TOXIC_DOCS = 4
#: English insults.
INSULTS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()

ABSTAIN, GOOD, BAD = 0, 1, 2
#: The share of bad documents is taken from the data and from so many imagined documents with the prior share.
PRIOR_DOCS = 20
#: A labeller's bad vote is at least so many times as frequent on bad documents as on good ones.
MIN_ODDS = 30
#: The scorer's probability is drawn towards the model's share of bad documents as by so many words.
PRIOR_WORDS = 5
#: Pseudo-counts of abstain, good and bad votes on good and on bad documents: a labeller is thought to mean what it says.
PRIOR = np.array([[0.5, 0.5, 0.02], [0.5, 0.5, 1]])
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0x80:] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LOWER = np.zeros(256, bool)
LOWER[0x61:0x7B] = True


def _share(flags: np.ndarray, words) -> np.ndarray:
    return np.bincount(words.doc, flags, len(words.count)) / np.maximum(words.count, 1)


def _any(table_: np.ndarray, words) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(table_[words.raw])))
    return total[words.ends] - total[words.starts]


def _vote(value: np.ndarray, bad, good) -> np.ndarray:
    return np.where(bad(value), BAD, np.where(good(value), GOOD, ABSTAIN))


def core_hashes(words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word without its last punctuation mark, and of its first four bytes (0: shorter)."""
    ends = words.ends - (~LETTER[words.data[words.ends - 1]] if len(words.ends) else 0)
    core = hash_spans(words.data, words.starts, np.maximum(ends, words.starts))
    long = ends - words.starts >= 5
    stem = np.where(long, hash_spans(words.data, words.starts, np.minimum(words.starts + 4, words.ends)), U(0))
    return core, stem


class Votes:
    """Votes of all labellers; quality[i] and toxic[i] are arrays by text. Most look for one fault and never vote good."""

    def __init__(self, words, keywords: np.ndarray, stems: np.ndarray):
        n = len(words.count)
        symbol, upper, lower = (_any(t, words) for t in (SYMBOL, UPPER, LOWER))
        length = words.ends - words.starts
        same = np.zeros(len(words.hash), bool)
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
        shout = (upper >= 2) & (lower == 0)
        bang = words.data[words.ends - 1] == 0x21 if len(words.ends) else np.zeros(0, bool)
        bang = bang & (words.data[np.maximum(words.ends - 2, 0)] == 0x21) & (length > 2)
        enough = words.count >= 20
        self.shape = {"symbol": symbol > 0, "upper": shout, "bang": bang, "same": same, "short": (length <= 3) & (symbol == 0)}
        s = {k: _share(v, words) for k, v in self.shape.items()}
        never = lambda x: np.zeros(n, bool)
        plain = np.maximum.reduce([s[k] for k in ("symbol", "upper", "bang", "same")])
        self.quality = [
            _vote(s["symbol"], lambda x: x > 0.25, never),
            _vote(s["upper"], lambda x: enough & (x > 0.5), never),
            _vote(s["bang"], lambda x: enough & (x > 0.25), never),
            _vote(s["same"], lambda x: enough & (x > 0.3), never),
            _vote(s["short"], lambda x: enough & (x < 0.03), lambda x: enough & (x > 0.15)),
            _vote(plain, never, lambda x: enough & (x < 0.05)),
        ]
        core, stem = core_hashes(words)
        self.core = core
        hits = [np.bincount(words.doc, np.isin(x, y), n) for x, y in ((core, LEXICON), (core, keywords), (stem, stems))]
        most = np.maximum.reduce(hits)
        known = [False, len(keywords) > 0, len(stems) > 0]
        self.toxic = [_vote(h, lambda x: x >= 2, lambda x, k=k: k & (x == 0) & (words.count > 0)) for h, k in zip(hits, known, strict=True)]
        self.toxic.append(_vote(most / np.maximum(words.count, 1), lambda x: (x > 0.01) & (most > 1), never))

    @staticmethod
    def pattern(votes: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(votes[0]), np.int64)
        for v in votes:
            out = out * 3 + v
        return out


def _word_hash(word: str) -> int:
    return int(words_of(word, SPACED).hash[0])


LEXICON = np.array(sorted(map(_word_hash, INSULTS)), U)


def unpack(patterns: np.ndarray, m: int) -> np.ndarray:
    return np.stack([(patterns // 3 ** (m - 1 - k)) % 3 for k in range(m)], 1) if len(patterns) else np.zeros((0, m), np.int64)


class LabelModel:
    """Dawid-Skene model of m labellers with abstentions; fitted on pattern counts."""

    def __init__(self, m: int, prior_bad: float = 0.1, accuracy: float = 0.8):
        self.m, self.bad, self.prior_bad = m, prior_bad, prior_bad
        # p[class, labeller, vote]; abstentions first taken as uninformative
        p = np.full((2, m, 3), 1.0)
        p[0, :, GOOD] = p[1, :, BAD] = accuracy
        p[0, :, BAD] = p[1, :, GOOD] = 1 - accuracy
        self.p = p / p.sum(2, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that the document is bad."""
        votes = unpack(np.asarray(patterns), self.m)
        logs = [np.log(q) + sum((np.log(self.p[c, k, votes[:, k]]) for k in range(self.m)), np.zeros(len(votes))) for c, q in ((0, 1 - self.bad), (1, self.bad))]
        out = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        return np.where((votes == ABSTAIN).all(1), self.bad, out) if len(votes) else out

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
        patterns, counts = np.asarray(patterns, np.int64), np.asarray(counts, float)
        votes = unpack(patterns, self.m)
        if not ((votes == GOOD).any() and (votes == BAD).any()):
            return self  # votes for one side alone tell nothing of accuracies or of the share: labellers stay as first taken
        for _ in range(rounds if counts.sum() else 0):
            r = self.posterior(patterns)
            self.bad = float(np.clip(((r * counts).sum() + PRIOR_DOCS * self.prior_bad) / (counts.sum() + PRIOR_DOCS), 1e-3, 0.5))
            for c, w in ((0, (1 - r) * counts), (1, r * counts)):
                for k in range(self.m):
                    n = np.bincount(votes[:, k], w, 3) + PRIOR[c]
                    self.p[c, k] = n / n.sum()
            for k in range(self.m):  # faults exclude each other, so a rarer fault must not be taken for chance
                if self.p[1, k, BAD] < MIN_ODDS * self.p[0, k, BAD]:
                    rate = (1 - self.bad) * self.p[0, k, BAD] + self.bad * self.p[1, k, BAD]
                    low = min(rate / (1 - self.bad + self.bad * MIN_ODDS), 0.9 / MIN_ODDS)
                    for c, new in ((0, low), (1, MIN_ODDS * low)):
                        self.p[c, k, :BAD] *= (1 - new) / self.p[c, k, :BAD].sum()
                        self.p[c, k, BAD] = new
        return self


def features(words, votes: Votes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed features of all texts: text, dimension, value; the last row of shape features are shares."""
    n, d = len(words.count), DIMS - 16
    key = words.doc.astype(np.int64) * DIMS + (votes.core % U(d)).astype(np.int64)
    u, c = np.unique(key, return_counts=True)
    doc, dim, value = u // DIMS, u % DIMS, np.log1p(c)
    norm = np.sqrt(np.bincount(doc, value**2, n))
    value = value / np.maximum(norm[doc], 1e-9)
    for k, flags in enumerate(votes.shape.values()):
        doc, dim, value = np.concatenate((doc, np.arange(n))), np.concatenate((dim, np.full(n, d + k))), np.concatenate((value, _share(flags, words)))
    return doc, dim, value


def train_shard(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Logistic weights for the two targets (DIMS + 1 each), by AdaGrad over the rows."""
    w, g = np.zeros((2, DIMS + 1)), np.full((2, DIMS + 1), 1e-8)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            dim, value, target = rows[i]
            dim, value = np.append(dim, DIMS), np.append(value, 1.0)
            p = 1 / (1 + np.exp(-np.clip(w[:, dim] @ value, -30, 30)))
            step = (p - target)[:, None] * value[None] + 1e-6 * w[:, dim]
            g[:, dim] += step**2
            w[:, dim] -= 0.5 * step / np.sqrt(g[:, dim])
    return w


def learn_words(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Keywords and stems that stand in toxic documents and in next to no other, from a bounded sample of labelled rows."""
    n = labels.count()
    labels = labels.select(F.col(id_col).alias("id"), "toxic").where("id is not null and toxic is not null")
    labels = labels.where(F.expr(f"pmod(xxhash64(id, 3), 1000000) < {ceil(1e6 * min(1.0, rows / max(n, 1)))}")).groupBy("id").agg(F.max("toxic").alias("toxic"))

    def count(batches):
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
            for i, j, words in chunks(batch.column("text"), SPACED):
                core, stem = core_hashes(words)
                for kind, h in ((0, core), (1, stem)):
                    doc, h = words.doc[h != 0], h[h != 0]
                    order = np.lexsort((doc, h))
                    h, doc = h[order], doc[order]
                    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.empty(0, bool)
                    u, back = np.unique(h[new], return_inverse=True)
                    bad = toxic[i:j][doc[new]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind), pa.int32()), pa.array(u.view(np.int64)), pa.array(np.bincount(back, bad, len(u)).astype(np.int64)), pa.array(np.bincount(back, 1 - bad, len(u)).astype(np.int64))], ["kind", "h", "bad", "good"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(labels), "id").select("toxic", "text").mapInArrow(thrifty(count), "kind int, h long, bad long, good long")
    found = found.groupBy("kind", "h").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = found.where(f"bad >= {MIN_TOXIC_DOCS} and good * 4 <= bad").select("kind", "h").toLocalIterator()
    lists = {0: [], 1: []}
    for r in found:
        lists[r["kind"]].append(r["h"])
    return tuple(np.sort(np.array(lists[k], np.int64).view(U)) for k in (0, 1))


def classify(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """id, bad_posterior, bad_score, toxic_posterior, toxic_score (probabilities) and kept, one row for each document."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    none = np.empty(0, U)
    keywords, stems = learn_words(docs, labels, id_col, text_col, labelled_rows) if labels is not None else (none, none)
    lists = spark.sparkContext.broadcast((keywords, stems))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def vote(batches):
        for batch in batches:
            for _, _, words in chunks(batch.column("text"), SPACED, fold=True):
                v = Votes(words, *lists.value)
                key, n = np.unique(Votes.pattern(v.quality) * 3**4 + Votes.pattern(v.toxic), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    patterns = own.select("text").mapInArrow(thrifty(vote), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    key, n = (np.array([r[c] for r in patterns], np.int64) for c in ("key", "n"))
    models = [LabelModel(6).fit(key // 3**4, n), LabelModel(4, 0.05).fit(key % 3**4, n)]

    total = own.count()
    shards = max(1, -(-min(total, train_rows) // SHARD_ROWS))

    def prepare(batches):
        for batch in batches:
            for _, _, words in chunks(batch.column("text"), SPACED):
                v = Votes(words, *lists.value)
                doc, dim, value = features(words, v)
                order = np.argsort(doc, kind="stable")
                cut = np.cumsum(np.bincount(doc, minlength=len(words.count)))[:-1]
                target = [m.posterior(Votes.pattern(x)) for m, x in zip(models, (v.quality, v.toxic), strict=True)]
                shard = (mix(np.add.reduceat(np.concatenate((words.hash, [U(0)])), np.minimum(words.first[:-1], len(words.hash)))) % U(shards)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(np.split(dim[order].astype(np.int32), cut), pa.list_(pa.int32())), pa.array(np.split(value[order].astype(np.float32), cut), pa.list_(pa.float32())), pa.array(target[0]), pa.array(target[1])], ["shard", "dims", "vals", "bad", "toxic"])

    def train(rows: pa.Table) -> pa.Table:
        data = sorted(zip(rows["dims"].to_pylist(), rows["vals"].to_pylist(), rows["bad"].to_pylist(), rows["toxic"].to_pylist(), strict=True))
        w = train_shard([(np.array(a), np.array(b), np.array([c, d])) for a, b, c, d in data])
        return pa.table({"n": [len(data)], "w": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    sample = own.where(F.expr(f"pmod(xxhash64(id, 5), 1000000) < {int(np.ceil(1e6 * min(1.0, train_rows / max(total, 1))))}"))
    trained = sample.select("text").mapInArrow(thrifty(prepare), "shard int, dims array<int>, vals array<float>, bad double, toxic double").groupBy("shard").applyInArrow(thrifty(train), "n long, w binary").collect()
    w = sum((np.frombuffer(bytes(r["w"]), np.float32).reshape(2, -1) * r["n"] for r in trained), np.zeros((2, DIMS + 1))) / max(1, sum(r["n"] for r in trained))
    weights = spark.sparkContext.broadcast(w.astype(np.float32))

    def judge(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), SPACED):
                v = Votes(words, *lists.value)
                doc, dim, value = features(words, v)
                p = [m.posterior(Votes.pattern(x)) for m, x in zip(models, (v.quality, v.toxic), strict=True)]
                s = [1 / (1 + np.exp(-np.clip(np.bincount(doc, weights.value[k][dim] * value, j - i) + weights.value[k][-1], -60, 60))) for k in (0, 1)]
                s = [(words.count * x + PRIOR_WORDS * m.bad) / (words.count + PRIOR_WORDS) for x, m in zip(s, models, strict=True)]
                kept = (p[0] + s[0] < 1) & (p[1] + s[1] < 1)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), *map(pa.array, (p[0], s[0], p[1], s[1], kept))], ["id", "bad_posterior", "bad_score", "toxic_posterior", "toxic_score", "kept"])

    out = own.mapInArrow(thrifty(judge), f"id {kind}, bad_posterior double, bad_score double, toxic_posterior double, toxic_score double, kept boolean")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
