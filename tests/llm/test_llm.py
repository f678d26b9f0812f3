"""The corpus operators against brute force on small, awkward tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from methspark.llm import decontaminate, jaccard_join, license_scan, lm_score, packing, quality_model, quality_rules, sharding, substring_dedup, url_filter
from methspark.llm._text import ALNUM, SPACED, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, shard int, node string"


def prose(seed, n, vocab=400):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, vocab, n))


PASSAGE = " ".join(f"p{x}" for x in np.random.default_rng(99).integers(0, 5000, 70))


def corpus():
    passage = PASSAGE
    texts = [None, "", " \n\t ", "One", "one", "a b c", "A b  c", prose(1, 3000), prose(2, 200), prose(2, 200), prose(2, 198) + " x y", prose(3, 120) + " " + passage, passage + " " + prose(4, 90), "The Cat. " * 60, "Été 中文 naïve " * 9, prose(5, 60) + " <|endoftext|>    end", "Licensed under the Apache License, Version 2.0. " + prose(6, 80), "### $$$ %%% " * 40]
    texts += [prose(7 + k % 9, 90) for k in range(40)]
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", "a", "b", None][i % 4], 0, "clash", 1, "clash") for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, "null id " + prose(8, 60), "en", "a", 0, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    spark.createDataFrame(corpus(), SCHEMA).createOrReplaceTempView("awkward")
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, fold=True):
    return WORD.findall((text or "").translate(LOWER) if fold else text or "")


def test_words_and_hashes():
    for t in ("", "A b", " x\x0by\x0c", "É eé z", "word" * 5000):
        w = words_of(t, SPACED)
        assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)] == words(t)
    a, b = words_of("ab ba ab abab", SPACED).hash, words_of("x" * 3_000_000 + " ab", SPACED).hash
    assert a[0] == a[2] == b[1] and len(set(a.tolist())) == 3


def test_scores(spark, docs, empty):
    train = docs.where("doc_id % 2 = 0")
    model, merged = lm_score.fit(train)
    counts: dict[str, int] = {}
    for r in corpus():
        if r[0] is not None and r[0] % 2 == 0:
            for t in [*words(r[1]), None]:
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert (model.n_tokens, model.n_words) == (n, v)
    whole = {(r.doc_id, r.n_tokens): r for r in lm_score.score(docs, model, merged).collect()}
    split = {(r.doc_id, r.n_tokens): r for r in lm_score.score(docs, model, merged, max_filter=200, max_vocab=0).collect()}
    for r in corpus():
        t = [*words(r[1]), None]
        got, other = whole[r[0], len(t)], split[r[0], len(t)]
        assert math.isclose(got.base_score, sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        assert got.n_known == sum(x in counts for x in t) == other.n_known
        assert math.isclose(got.score, other.score, rel_tol=1e-9) and math.isclose(got.base_score, other.base_score, rel_tol=1e-9)
    none, kept = lm_score.fit(empty)
    assert none.n_tokens == 0 and lm_score.score(docs, none, kept).count() == len(corpus()) and lm_score.score(empty, model, merged).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_interpolated_model(spark, docs, order):
    """The score against exact counts, rounded to levels, in one pass and in many (the filter is wide, so hardly a probe is wrong)."""
    model, merged = lm_score.fit(docs.where("doc_id % 2 = 0"), order=order, per_entry=60)
    grams: list[dict] = [{} for _ in range(order)]
    for r in corpus():
        if r[0] is not None and r[0] % 2 == 0:
            t = [None] * (order - 1) + [*words(r[1]), None]
            for k in range(order - 1, len(t)):
                for m in range(order):
                    key = tuple(t[k - m : k + 1])
                    grams[m][key] = grams[m].get(key, 0) + 1
    n, v = sum(grams[0].values()), len(grams[0])
    low = lambda c: max((x for x in lm_score.LEVELS.tolist() if x <= c), default=0)
    high = lambda c: min(x for x in lm_score.LEVELS.tolist() if x > c) - 1 if c else 0
    pairs = sum(len(g) for g in grams[1:]) / (order - 1)
    assert math.isclose(sum(low(c) ** model.beta for c in grams[0].values()), pairs, rel_tol=1e-6) or model.beta > 0.999
    got = {}
    for most in (1 << 30, 2000):
        got[most] = {(r.doc_id, r.n_tokens): r.score for r in lm_score.score(docs, model, merged, max_filter=most).collect()}
    assert got[1 << 30] == got[2000]
    for r in corpus():
        t, want = [None] * (order - 1) + [*words(r[1]), None], 0.0
        for k in range(order - 1, len(t)):
            p = (low(grams[0].get((t[k],), 0)) + 1) / (n + v + 1)
            for m in range(1, order):
                h = grams[m - 1].get(tuple(t[k - m : k]), 0)
                above = high(h) if m == 1 or k >= order else 0
                kinds = max(above, 1) ** model.beta
                p = (min(low(grams[m].get(tuple(t[k - m : k + 1]), 0)), above) + kinds * p) / (above + kinds)
            want += math.log10(p)
        assert math.isclose(got[2000][r[0], len(t) - order + 1], want, rel_tol=1e-6)


def test_filter_holds_every_count():
    h = np.random.default_rng(1).integers(1, 1 << 62, 5000, dtype=np.uint64)
    c = np.random.default_rng(2).zipf(1.5, 5000) % 100_000 + 1
    import pyarrow as pa

    seg = lm_score.segment(pa.table({"kind": [2], "bucket": [0], "hashes": [h.tobytes()], "counts": [c.astype(np.int64).tobytes()]}), 10)
    low, high = lm_score.bounds(lm_score.Filter(1, {0: seg["filter"][0].as_py()}).level(h))
    assert (high >= np.minimum(c, high.max())).all() and (low <= c).mean() > 0.97


@pytest.mark.parametrize("tail", [0, 70])
def test_repeats_of_documents_between_the_first_and_the_last(spark, tail):
    """Every seed of a changed passage has another first and another last document, which hold too little of it; the document between them that holds all is found.

    tail: words that follow in both and that the first document holds too, so the passage's run of seeds is covered in part."""
    rng = np.random.default_rng(5)
    fresh = lambda n: ["x" + str(x) for x in rng.integers(1 << 40, 1 << 50, n)]
    passage, end = fresh(200), fresh(tail)
    texts = [fresh(20) + end]
    bits = [passage[a : a + 21] for a in range(0, 200, 16)]
    texts += [fresh(30) + x + fresh(30) for x in bits]
    whole = len(texts)
    texts += [fresh(10) + passage + end + fresh(10), fresh(25) + ["to"] * 90 + fresh(5)]
    texts += [fresh(30) + x + fresh(30) for x in bits]
    last = len(texts)
    texts += [fresh(40) + [w + "y" if n % 10 == 9 else w for n, w in enumerate(passage)] + end + fresh(40)]
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    found = {r.row: r for r in substring_dedup.merged(substring_dedup.repeats(docs).withColumn("row", F.col("doc_id"))).collect()}
    assert set(found) == ({whole, last} if tail else {last}) and whole in found[last].partners
    assert found[last].spans[0].start <= 45 and found[last].spans[-1].end >= 235 + tail and len(found[last].spans) == 1


def test_repeats_across_documents(spark, docs, empty):
    found = substring_dedup.merged(substring_dedup.repeats(docs)).collect()
    assert {tuple(p for p in r.partners) for r in found} >= {(8,), (11,)}
    cut = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert PASSAGE in cut[11] and PASSAGE[:100] not in cut[12] and prose(4, 90) in cut[12]
    assert cut[7] == corpus()[7][1] and cut[0] is None and not cut[9].strip()
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_chain_is_the_best():
    rng = np.random.default_rng(3)
    for _ in range(50):
        parts = sorted({(int(a), int(b), 5) for a, b in rng.integers(0, 60, (8, 2))})
        got = max(c[4] for c in substring_dedup.chain(parts))
        assert got >= 5 and sum(c[4] for c in substring_dedup.chain(parts)) == 5 * len(parts)


def test_classifier(spark, docs, empty):
    labels = spark.createDataFrame([(13, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_model.classify(docs, labels).collect()}
    assert len(got) == len(corpus()) - 1 and not got[17].kept and got[7].kept
    assert quality_model.classify(empty, labels).count() == 0 and quality_model.classify(docs).count() == len(corpus())


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    files = packing.public_files()
    whole = Tokenizer.from_file(files[0])
    ids = {(r[0], r[1]): [*whole.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in corpus()}
    pieces = packing.pack(docs, *files, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    for (i, _), want in ids.items():
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert own[0].doc_tokens == len(want)
        if i == 8:  # the repeated row: both copies whole
            assert sum(p.length for p in own) == 2 * len(want)
        else:
            assert [x for p in own for x in p.ids] == want
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert packing.pack(empty, *files).count() == 0


def test_contamination(spark, docs, empty):
    items = [("1", prose(1, 30)), ("2", "one"), ("3", None), ("4", "the CAT"), ("5", ""), ("6", prose(77, 20))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    want = {}
    for r in corpus():
        w, hit, ids = word.findall((r[1] or "").translate(LOWER)), set(), set()
        for item, text in items:
            v = word.findall((text or "").translate(LOWER))
            n = min(10, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1) if n else ():
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    ids.add(item)
        want[r[0], len(w)] = (len(hit), sorted(ids))
    for most in (10**6, 20):
        got = decontaminate.contamination(docs, bench, max_windows=most).collect()
        assert len(got) == len(corpus())
        for r in got:
            assert (sum(x.end - x.start for x in r["hits"]), sorted(r["items"])) == want[r.doc_id, r.n_words]
    clean = {r.doc_id: r.text for r in decontaminate.remove_contamination(docs, bench).collect()}
    assert clean[8] == corpus()[8][1] and "Cat" not in clean[13] and clean[3] == ""
    assert decontaminate.remove_contamination(docs, bench, whole_documents=True).where("doc_id = 13").count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0 and hashlib.sha256(b"").hexdigest()[:4] == "e3b0"


def test_sharding(spark, docs, empty):
    rows = sharding.interleave(docs, 8, rows_per_bucket=7).collect()
    sizes = [sorted(r.slot for r in rows if r.shard == k) for k in range(8)]
    assert sum(map(len, sizes)) == len(corpus()) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert all(s == list(range(len(s))) for s in sizes)
    share = [sum(r.source == "a" for r in rows if r.shard == k) for k in range(8)]
    assert max(share) - min(share) <= 2 and sharding.interleave(empty).count() == 0


def test_quality_counts(spark, docs, empty):
    got = {}
    for r in quality_rules.judged(docs).select("doc_id", "quality.*").collect():
        got[r.doc_id, r.n_words] = r
    for row in corpus():
        w, text = words(row[1], False), row[1] or ""
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[row[0], len(w)]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.judged(empty).count() == 0


def test_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    d = spark.range(1).select(quality_rules.distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    assert math.isclose(d, math.sqrt((kl(p) + kl(q)) / 2))


def test_licenses(spark, docs, empty):
    noisy = "Permission is hereby granted free of any charge, to any person obtaining one copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and or sell copies of the Software and to permit persons to whom the Software is furnished to do so"
    more = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(900, "Foo. " + noisy + " Bar")], "doc_id long, text string"))
    got = {r.doc_id: [(m["license"], m["start"], m["end"]) for m in r.matches] for r in license_scan.scan_licenses(more).collect()}
    assert got[16] == [("Apache-2.0", 0, 8)] and got[7] == [] and got[0] == []
    assert [x[0] for x in got[900]] == ["MIT"] and license_scan.scan_licenses(empty).count() == 0


def test_license_repeats_and_changes():
    """Back to back repeats are all reported, and so is every text with as many changed words as the coverage allows."""
    index = license_scan.TemplateIndex(license_scan.TEMPLATES)
    scan = lambda text: [(m[0], m[2], m[3]) for m in index.scan(words_of(text, ALNUM), license_scan.COVERAGE, license_scan.BAND)[0]]
    assert scan((license_scan.TEMPLATES["Apache-2.0"] + " ") * 5) == [("Apache-2.0", 8 * k, 8 * k + 8) for k in range(5)]
    assert scan("All rights reserved. " * 3) == [("all-rights-reserved", 3 * k, 3 * k + 3) for k in range(3)]
    rng = np.random.default_rng(8)
    for name, template in license_scan.TEMPLATES.items():
        plain = re.findall("[0-9A-Za-z]+", template)
        most = int((1 - license_scan.COVERAGE) * len(plain) + 1e-9)
        for _ in range(12):
            w = list(plain)
            for at in rng.choice(len(w), most, replace=False):
                w[at] = f"x{rng.integers(1e6)}"
            own = [(s, e) for n, s, e in scan(prose(1, 30) + " " + " ".join(w) + " " + prose(2, 30)) if n == name]
            assert own and own[0][0] >= 30 and own[0][1] <= 30 + len(w), (name, w)


@pytest.mark.parametrize("percent,size", [(85, 4), (80, 5), (50, 1)])
def test_jaccard(spark, docs, empty, percent, size):
    rng = np.random.default_rng(percent)
    rows = corpus()
    for k in range(60):
        w = words(rows[7 + k % 3][1])[: 40 + k]
        for at in rng.integers(0, len(w), k % 5):
            w[at] = f"e{rng.integers(1e6)}"
        rows.append((100 + k, " ".join(w), *rows[0][2:]))
    df = spark.createDataFrame(rows, SCHEMA)
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = sorted((rows[i][0] if rows[i][0] is not None else -1, len(sets[i]), min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=-1)) for i in range(len(rows)))
    got = jaccard_join.jaccard_components(df, percent, size).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got) == want
    assert jaccard_join.jaccard_components(empty, percent, size).count() == 0


def test_one_deletion_segments_lose_nothing():
    rng = np.random.default_rng(5)
    plan = jaccard_join.Plan(85, 200, 1000, 0.1, np.empty(0, np.uint64))
    plan.plan = [(h, *((e % 2 + (e // 2) * 0, (e + 2 * d - e % 2 + 1) // 2, s) if h else (e, d, s))) for h, e, d, s in plan.plan]
    for _ in range(60):
        a = np.unique(rng.integers(1, 1 << 63, 120, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.permutation(len(a))[:113]], rng.integers(1, 1 << 63, 4, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        out = [set(plan.entries(np.zeros(len(x), np.int64), x, np.array([len(x)]))[0].tolist()) for x in (a, b)]
        assert out[0] & out[1]


def test_urls(spark, empty):
    urls = ["http://a.example.org/es/x", "https://EXAMPLE.org/en/177?q", "http://x.org", "http://x.org/", "http://com/fr/1#a", "http://b.com/de/", "org/", None, "", "http://notexample.org/es/", "ftp://de.com/fr", "http://a.com/FR/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    for i, u in enumerate(urls):
        host, path = url_filter.parts(u)
        fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert got[i] == (host, path, best and best.name, best.verdict if best else "allow")
    assert got[1][2] == "example.org/en/1" and got[2][2] is None and url_filter.filter_urls(pages.where("false")).count() == 0
    wild = [url_filter.Rule("*.net", "/*/ads", "block"), url_filter.Rule("ads*.com", "", "block")]
    more = spark.createDataFrame([(1, "http://q.net/a/ads/1"), (2, "http://ads7.com"), (3, "http://net/ads")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(more, wild).orderBy("page_id").collect()] == ["block", "block", "allow"]
