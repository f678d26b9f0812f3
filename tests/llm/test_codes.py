"""Spelling variants, byte-level BPE and vector codes against brute force."""

import hashlib
import zlib

import numpy as np
import pytest

from methspark.llm import byte_bpe, spelling, vector_codes

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts: dict[str, int], ratio: int = 10) -> dict:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    root = {}
    for w in counts:
        at = w
        while form[at] is not None:
            at = form[at]
        root[w] = at
    return {w: (counts[w], len(near[w]), form[w], counts.get(form[w]), root[w]) for w in counts}


@pytest.mark.parametrize("letters,seed", [("abcdéÿzq", 1), ("aé", 2)])
def test_variants_are_those_of_all_pairs(spark, letters, seed):
    """Also of a dense vocabulary, where every count of symbols leaves words together."""
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list(letters), rng.integers(7, 12))) for _ in range(60)]
    counts = {w: int(10 ** rng.integers(1, 4)) for w in base}
    for w in base * 4:
        k = int(rng.integers(len(w)))
        v = w[:k] + str(rng.choice(["", *letters])) + w[k + int(rng.integers(2)) :]
        counts.setdefault(v, int(rng.integers(2, 30)))
    counts |= {"": 5, "x": 3, "日本語文字列一二": 40, "日本語文字列一三": 2, "q" * 5000: 7, "q" * 4999: 90}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == brute_variants(counts) and len(got) == len(counts)


def test_forms_of_forms(spark):
    counts = {"variant": 2, "varient": 20, "varieent": 200, "varieents": 2000, "alone": 1}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == {w: "alone" if w == "alone" else "varieents" for w in counts}


def test_words_and_slips(spark):
    """Runs of letters, A-Z alone in lower case, one letter left out by the hash; null ids and texts, repeated rows."""
    import regex

    texts = [(k % 7 if k % 5 else None, None if k == 3 else f"Straßen-ÀÉcole Encyclopédie{k} WONDERFUL÷times x{'abcdefgh' * k}") for k in range(60)]
    want: dict[str, int] = {}
    for k, t in texts:
        for w in regex.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in w)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                want[w] = want.get(w, 0) + 1
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id long, text string, word string")
    got = {r.word: r.n for r in spelling.vocabulary(spelling.slipped(spelling.runs(docs))).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    empty = spelling.variants(spelling.vocabulary(spelling.slipped(spelling.runs(docs.limit(0)))))
    assert empty.count() == 0


def test_ids_are_the_librarys(spark):
    """Random texts of many scripts, white space and letters of late Unicode, pieces of all lengths; both ways."""
    rng = np.random.default_rng(5)
    pools = ["abcdefghijklmnopqrst'sdmrv  ", "éàüßœ ñ ", "日本語の漢字テスト", "абвгд еж", " \n\t\r 　 a", "0123456789½²٣ ", "🙂👍🏽‍♀️ ‍", "՘֋꟎\U000323b0\U00011de0 x", "$%^&*()!'re'll"]
    texts = [None, "", " ", "'s", "a" * 9000, "ab" * 40 + " " + "é" * 33]
    for k in range(600):
        pool = list(pools[k % len(pools)] if k % 3 else "".join(pools))
        texts.append("".join(rng.choice(pool, rng.integers(1, 90))))
    texts.append("".join(rng.choice(list("acgt"), 30000)))
    df = spark.createDataFrame([(k, t, 1, None) for k, t in enumerate(texts)], "doc_id long, text string, `0` int, Text2 string").repartition(3)
    theirs = library()
    rows = byte_bpe.decode(byte_bpe.encode(df, RANKS, PATTERN), RANKS).collect()
    for r in rows:
        assert r.ids == theirs.encode_ordinary(texts[r.doc_id] or "") and bytes(r.bytes) == (texts[r.doc_id] or "").encode()
    assert len(rows) == len(texts) and rows[0]["0"] == 1
    assert byte_bpe.decode(df.selectExpr("cast(null as array<int>) as ids"), RANKS).first().bytes == b""
    assert byte_bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0


def test_whole_texts_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in byte_bpe.query(spark, SF).collect()}
    theirs = library()
    for d in docs:
        ids = np.array(theirs.encode_ordinary(d.text or ""), "<u4")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
    assert len(got) == len(docs)


def test_rows_and_single_trees_agree():
    rng = np.random.default_rng(8)
    ranks = byte_bpe.ranks_of(RANKS)
    pairs = byte_bpe.Pairs(ranks)
    for leaves in (8, 16, 64):
        words = [bytes(rng.choice(list(b"aaeinrst \xc3\xa9"), rng.integers(2, leaves + 1)).tolist()) for _ in range(300)] + [b"a" * leaves, b"ab" * (leaves // 2)]
        assert byte_bpe.merged_rows(words, leaves, pairs) == [byte_bpe.merged(w, ranks) for w in words]


def brute_books(vectors: np.ndarray, parts: int, entries: int, rounds: int) -> tuple[np.ndarray, list, list]:
    cut = vectors.reshape(len(vectors), parts, -1).tolist()
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def near(p, v):
        return min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [[near(p, v[p])[1] for v in cut] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, h in zip(cut, held[p], strict=True) if h == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    return books, [[k for _, k in f] for f in found], [sum(d for d, _ in f) for f in found]


def test_codes_are_those_of_all_distances(spark):
    """Ties, repeated vectors and ids, null and non-finite components, short vectors, very large components."""
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(size=(400, 16)), 1)
    v[50:120] = v[3]
    v[120:200] = np.round(v[120:200])
    v[7, 2], v[8, 9] = 1e30, -70000.0
    rows = [(k, v[k].tolist(), k % 3 if k % 4 else None) for k in range(400)]
    rows += [(400, v[5].tolist()[:13], 1), (5, v[5].tolist(), 9), (None, v[6].tolist(), 9), (401, None, 1), (402, [None] * 16, 1), (403, [float("nan")] + [0.0] * 15, 1), (404, [float("inf")] + [0.0] * 15, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(5)
    books = vector_codes.fit(df, "vec_id", "embedding")
    kept = sorted((r for r in rows[:403]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    bound = int(np.sqrt((1 << 62) // 16)) // 2
    ints = np.array([[int(np.clip(np.floor(x * 4096), -bound, bound)) for x in [*r[1], *[0.0] * (16 - len(r[1]))]] for r in kept], object)
    want, codes, errors = brute_books(ints, 8, 16, 6)
    assert books.entries.tolist() == want
    got = vector_codes.encode(df, books, "embedding").collect()
    key = lambda i, c, e, g: (i is None, i or 0, c, e, g is None, g or 0)
    assert sorted(key(r.vec_id, r.code, r.error, r.label) for r in got) == sorted(key(r[0], c, e, r[2]) for r, c, e in zip(kept, codes, errors, strict=True))
    back = vector_codes.decode(vector_codes.encode(df, books, "embedding"), books).collect()
    assert all(r.vector == [x / 4096 for p, c in enumerate(r.code) for x in want[p][c]] for r in back)


def test_tree_rules_out_no_nearest(monkeypatch):
    """Every tie and every rounding, for entries on a small grid and for large integers; some distances are not computed."""
    rng = np.random.default_rng(6)
    done = []
    plain = vector_codes._squares
    for scale, spread in ((1, 4), (10**8, 3), (4096, 200)):
        entries = rng.integers(-spread, spread, (16, 3)) * scale
        points = np.concatenate((rng.integers(-spread, spread, (3000, 3)) * scale, entries))
        tree = vector_codes.grow(entries, list(range(16)))
        monkeypatch.setattr(vector_codes, "_squares", lambda p, e: (done.append(len(p)), plain(p, e))[1])
        which, far = vector_codes.nearest(tree, entries, points)
        monkeypatch.setattr(vector_codes, "_squares", plain)
        every = ((points[:, None] - entries) ** 2).sum(axis=2)
        assert (far == every.min(axis=1)).all() and (which == every.argmin(axis=1)).all()
    assert sum(done) < 0.9 * 16 * 3016 * 3


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    books = vector_codes.fit(df, "vec_id", "embedding")
    assert vector_codes.encode(df, books, "embedding").count() == 0 and books.text() == ""
    one = spark.createDataFrame([(1, [0.5] * 4, 2)], "vec_id long, embedding array<float>, label int")
    assert vector_codes.encode(one, vector_codes.fit(one, "vec_id", "embedding"), "embedding").first().error == 0


def test_items_without_ids_in_many_blocks(spark):
    """Null and repeated item ids; twenty blocks: the same results as one, one word set in a plan's Python node at a time."""
    from methspark.llm import decontaminate

    rng = np.random.default_rng(12)
    words = [f"w{k}" for k in range(900)]
    items = [(None if k % 9 == 0 else f"i{k % 40}", " ".join(rng.choice(words, rng.integers(1, 25)))) for k in range(120)] + [(None, "one two three"), ("a", "one two three"), ("b", None)]
    texts = [(k, None if k % 17 == 0 else " ".join([*rng.choice(words, 30), *items[int(rng.integers(120))][1].split(), *rng.choice(words, 5), "one two three"]), "x") for k in range(90)]
    docs = spark.createDataFrame([*texts, texts[1]], "doc_id long, text string, n_words string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    size = sum(len(t or "") for _, t in items)
    one, many = (decontaminate.contamination(docs, bench, max_windows=n) for n in (10**6, size // 38))
    assert len(decontaminate.window_blocks(bench, 10, "item_id", "text", size // 38)) >= 19
    rows = lambda df: sorted((r.doc_id, r.n_words, [(h.start, h.end) for h in r.hits], r["items"]) for r in df.collect())
    got = rows(one)
    assert got == rows(many) and len(got) == 91 and any("" in x[3] and "a" in x[3] for x in got)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 2 * 2
    clean = [sorted(map(str, decontaminate.remove_contamination(docs, bench, max_windows=n).collect())) for n in (10**6, size // 38)]
    assert clean[0] == clean[1] and not any("one two three" in r for r in clean[0])


def test_winnowed_candidates_are_enough(monkeypatch):
    """Texts with changed, cut and mixed templates: the same licenses at the same places as when every place of a text is tried."""
    import re

    from methspark.llm import license_scan as L
    from methspark.llm._text import ALNUM, words_of

    class Everywhere(L.TemplateIndex):
        def candidates(self, words):
            return {(d, t): list(range(-len(self.words[t]), int(words.count[d]))) for d in range(len(words.count)) for t in range(len(self.names))}

    rng = np.random.default_rng(3)
    known, every = L.TemplateIndex(L.TEMPLATES), Everywhere(L.TEMPLATES)
    kept = {}
    for (_, _), places in known.index.items():
        for t, _ in places:
            kept[t] = kept.get(t, 0) + 1
    assert any(len(w) > 150 and kept[t] < 0.75 * len(w) for t, w in enumerate(known.words))  # winnowed
    for trial in range(40):
        text = []
        for _ in range(3):
            text += [f"x{rng.integers(30)}" for _ in range(rng.integers(0, 15))]
            own = re.findall("[0-9A-Za-z]+", L.TEMPLATES[str(rng.choice(list(L.TEMPLATES)))])
            for at in rng.choice(len(own), int(rng.uniform(0, 0.3) * len(own)), replace=False):
                own[at] = f"y{rng.integers(1000)}" if trial % 2 else ""
            text += [w for w in own if w]
        words = words_of(" ".join(text), ALNUM)
        a, b = (x.scan(words, L.COVERAGE, L.BAND)[0] for x in (known, every))
        assert [m[0] for m in a] == [m[0] for m in b] and all(min(x[3], y[3]) > max(x[2], y[2]) for x, y in zip(a, b, strict=True))


def test_many_notices_in_one_text():
    """Time grows with the notices, not with their square."""
    import time

    from methspark.llm import license_scan as L
    from methspark.llm._text import ALNUM, words_of

    index, took = L.TemplateIndex(L.TEMPLATES), {}
    for n in (500, 2000):
        words, began = words_of("All rights reserved. and some text. " * n, ALNUM), time.perf_counter()
        found = index.scan(words, L.COVERAGE, L.BAND)[0]
        took[n] = time.perf_counter() - began
        assert len(found) == n
    assert took[2000] < 8 * took[500]


def test_scores_do_not_depend_on_the_layout(spark):
    """Trained and asked on one partition and on many: equal scores."""
    from methspark.llm import lm_score

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = []
    for n in (1, 37):
        own = docs.repartition(n)
        model, merged = lm_score.fit(own.where("doc_id % 7 <> 2"))
        got.append((model.buckets, model.n_tokens, model.n_words, model.beta, model.end_level, sorted(model.sizes), sorted((r.kind, r.bucket, bytes(r.filter)) for r in merged.select("kind", "bucket", "filter").collect())))
    assert got[0] == got[1]


def test_places_of_many_files(spark, tmp_path, monkeypatch):
    """Ranks of files from a list and from a table are the same."""
    from methspark.llm import _spark

    spark.range(500).repartition(9).write.parquet(str(tmp_path / "t"))
    rows = []
    for most in (_spark.MAX_FILES, 4):
        monkeypatch.setattr(_spark, "MAX_FILES", most)
        rows.append(sorted(map(tuple, _spark.placed(spark.read.parquet(str(tmp_path / "t")), "place").collect())))
    assert rows[0] == rows[1] and len({p for _, p in rows[0]}) == 500


def test_classifier_without_labels(spark):
    """Clean documents stay where no label tells what is toxic; labels that disagree count as toxic."""
    from pyspark.sql import functions as F

    from methspark.llm import quality_model

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id: r.kept for r in quality_model.classify(docs).select("doc_id", "kept").collect()}
    clean = [r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()]
    assert len(kept) == docs.count() and sum(kept[k] for k in clean if k in kept) >= 0.97 * len(clean)
    twice = labels.unionByName(labels.withColumn("toxic", F.lit(0).cast(labels.schema["toxic"].dataType)))
    lists = [[x.tolist() for x in quality_model.learn_words(docs, x, "doc_id", "text", 10**6)] for x in (labels, twice, twice.repartition(5))]
    assert lists[0] == lists[1] == lists[2]
