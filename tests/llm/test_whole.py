"""Each operator does the whole job, whatever the size of its tables or blocks."""

import numpy as np

from methspark.llm import align, decontaminate, jaccard_join, packing, quality_rules, substring_dedup

from .test_llm import SCHEMA, corpus, docs, empty, prose  # noqa: F401


def test_packing_finds_neighbours_of_the_whole_table(spark):
    """Copies meet in one window though the table has many shards, by whatever number of passes over the vocabulary."""
    rows = [(100 * c + k, prose(1000 + k, 120, 4000) + f" only{c}x{k}", None, None, 0, None, None, None) for k in range(60) for c in range(2)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4, "doc_id")
    got = []
    for most in (10**7, 500):
        pieces = packing.pack(table, *packing.public_files(), docs_per_shard=12, max_vocabulary=most, partition_words=4000).collect()
        by_doc = {}
        for p in pieces:
            by_doc.setdefault(p.doc_id, set()).add(p.sequence_id)
        assert len(by_doc) == 120 and len({s >> 32 for x in by_doc.values() for s in x}) > 2
        assert sum(bool(by_doc[k] & by_doc[100 + k]) for k in range(60)) >= 54
        got.append(sorted((p.doc_id, p.start, p.ids_crc32, p.offset) for p in pieces))
    assert got[0] == got[1]


def test_packing_asks_with_every_term():
    """A document that shares only a light term of the seed is a neighbour; statistics are those given."""
    from methspark.llm._text import ALNUM, Words, buffers
    import pyarrow as pa

    texts = [" ".join(f"h{k}" for k in range(40)) + " light", " ".join(f"h{k}" for k in range(40)), "light other"]
    words = Words(*buffers(pa.array(texts, pa.large_string())), ALNUM)
    doc, term, tf = packing.doc_terms(words)
    light = words.hash[words.first[1] - 1] >> np.uint64(20)
    df = np.where(term == light, 900, 2)
    for dense in (1, 8):  # lists as such, and as rows of a matrix
        packing.DENSE, old = dense, packing.DENSE
        assert packing.BM25(doc, term, tf, words.count, df, 1000, 30.0).neighbours(0, np.zeros(3, bool)).tolist() == [1, 2]
        packing.DENSE = old


def test_ids_are_the_tokenizers(spark):
    """The ids of whole documents, and of awkward texts, by the tokenizer file alone; in one batch, again from the cache, and with a small cache."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from methspark.llm._text import buffers

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()[:400]
    texts += [None, "", " ", "  ", "a", " a", "a ", "a  b", "a b ", " a b", "a\n b", "a \nb", "x\t y z", "caf\u00e9 na\u00efve", "a\u00a0 b c", "a \u2003b c", "\u4e2d\u6587 \u4e2d a", "I'm we're it's 'll", "<|endoftext|> a b", "a <|endoftext|> b <|endo", "a <b c", "\x1c a\x1d b", "1 2 33 a1 1a", "! ? !!! a,b", "\u0130 \u017f \u01c5 x", "\U0001f600 a \U0001f600b"]
    rng = np.random.default_rng(21)
    texts += ["".join(rng.choice(list("ab1 ,.'\n\t\u00e9\u00a0\u4e2d<|>"), rng.integers(0, 60))) for _ in range(1500)]
    whole = Tokenizer.from_file(packing.public_files()[0])
    want = [[*whole.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
    for ranks in (packing.public_files()[1:], (None, None)):
        enc = packing.Encoder(packing.public_files()[0], *ranks)
        for cache in (packing.CACHE, 2000):
            packing.CACHE, old = cache, packing.CACHE
            for k in range(0, len(texts), 300):
                ids, at = enc.batch(*buffers(pa.array(texts[k : k + 300], pa.large_string())))
                assert [x.tolist() for x in np.split(ids, at[1:-1])] == want[k : k + 300]
            packing.CACHE = old


def test_pieces_that_recur_are_encoded_once(monkeypatch):
    """Beyond the bound of the cache the pieces that came again stay; words are the same at a line's end and before a sign; ids are the tokenizer's."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from methspark.llm._text import buffers

    whole, enc, asked = Tokenizer.from_file(packing.public_files()[0]), packing.Encoder(*packing.public_files()), []
    monkeypatch.setattr(packing, "CACHE", 300)
    fast = enc.fast

    class Told:
        def encode_ordinary(self, text):
            asked.append(text)
            return fast.encode_ordinary(text)

    enc.fast = Told()
    often = [f"word{k}" for k in range(40)]
    for step in range(12):
        seldom = [f"rare{step}x{k}" for k in range(100)]
        texts = [" ".join(["It", *often, *seldom]), "It " + ", ".join(often) + ", it", "It " + ". it\n".join(often) + ". end", "\u00d7. \u00f7, \u0117, a\n\nb' c\n \u00e9. d"]
        ids, at = enc.batch(*buffers(pa.array(texts, pa.large_string())))
        assert [x.tolist() for x in np.split(ids, at[1:-1])] == [[*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    said = " ".join(asked)
    assert sum(said.count(f"rare{step}x") for step in range(12)) == 1200
    # the first batch counts no piece as one that came again
    assert max(said.count(w + " ") + said.count(w + "\n") for w in often) <= 2
    assert not any(w + sign in said for w in often for sign in (",", "."))


def test_windows_are_those_of_whole_lists():
    """The lists lose used documents on the way, and windows are those that full scores and sorts give."""
    rng = np.random.default_rng(4)
    for n, dense in ((1, 8), (90, 8), (400, 8), (400, 1)):
        own = [np.unique(rng.zipf(1.3, rng.integers(0, 60)) % 900) for _ in range(n)]
        own[1::7] = own[: len(own[1::7])]  # equal scores
        doc, term = np.repeat(np.arange(n), [len(x) for x in own]), np.concatenate(own).astype(np.uint64) << np.uint64(30)
        words, lengths, tf = np.array([len(x) for x in own]), rng.integers(1, 1500, n), rng.integers(1, 4, len(doc))
        lengths[::50] = 5000
        df = np.unique(term, return_inverse=True, return_counts=True)
        df = df[2][df[1]]
        packing.DENSE, old = dense, packing.DENSE
        index = packing.BM25(doc, term, tf, words, df, n, 20.0)
        packing.DENSE = old
        weight, many = packing.weights(df, tf, words[doc], n, 20.0), np.bincount((term >> np.uint64(30)).astype(int), minlength=900)
        table = np.zeros((900, n))
        table[(term >> np.uint64(30)).astype(int), doc] = weight
        often = many * dense > n

        def ranked(seed, used):
            mine = own[seed].astype(int)
            score = table[mine[often[mine]]].sum(0) if n > 1 else np.zeros(n)
            rest = np.zeros(n)
            for t in mine[~often[mine]]:
                rest += table[t]
            score = score + rest
            score[used] = score[seed] = 0
            return [int(d) for d in np.argsort(-score, kind="stable") if score[d]]

        used, want, offset, sequence = np.zeros(n, bool), [], 0, 0
        queue = []
        while not used.all():
            d = next((k for k in queue if not used[k]), None)
            if d is None:
                d = int(np.flatnonzero(~used)[0])
                queue = ranked(d, used)
            used[d], start = True, 0
            while start < lengths[d]:
                take = min(int(lengths[d]) - start, 2048 - offset)
                want.append((d, start, take, sequence, offset))
                start, offset = start + take, offset + take
                if offset == 2048:
                    sequence, offset = sequence + 1, 0
                    queue = ranked(d, used) if start < lengths[d] else []
        assert packing.fill(index, lengths, 2048) == want
        assert len(index.docs) < max(2 * packing.FEW, n // 2)


def test_terms_are_found_by_their_leading_bits():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 1000, 60000):
        known = np.append(np.unique(rng.integers(0, 1 << 44, n).astype(np.uint64)), packing.LAST)
        asked = np.concatenate((known[:-1], rng.integers(0, 1 << 44, 3000).astype(np.uint64), np.array([0, (1 << 44) - 1], np.uint64)))
        assert (packing.finder(known)(asked) == np.searchsorted(known, asked)).all()


def test_removal_does_not_depend_on_blocks(spark, docs):  # noqa: F811
    """Overlapping hits of items in different blocks are all cut; words that a cut brings together are no hit."""
    w = [f"q{k}" for k in range(40)]
    items = [(str(k), " ".join(w[a : a + 10])) for k, a in enumerate(range(0, 30, 5))]
    items += [("j", " ".join(w[30:35] + ["left"] + ["right"] + w[35:38])), *[(f"n{k}", prose(7 + k % 9, 12)) for k in range(9)]]
    texts = ["a b " + " ".join(w[:15]) + " c d", " ".join(w[30:35]) + " left " + " ".join(w[:10]) + " right " + " ".join(w[35:38]), "no hit, None", None, ""]
    bench = spark.createDataFrame(items, "item_id string, text string")
    table = docs.unionAll(spark.createDataFrame([(500 + k, t, None, None, 0, None, None, None) for k, t in enumerate(texts)], SCHEMA))
    for whole in (False, True):
        one, many = ([(r.doc_id, r.text) for r in decontaminate.remove_contamination(table, bench, whole_documents=whole, max_windows=n).collect()] for n in (10**6, 20))
        assert one == many
        if not whole:
            got = dict(many)
            assert got[500] == "a b  c d" and got[501] == texts[1].replace(" ".join(w[:10]), "") and got[502] == texts[2] and got[503] is None


def shared_windows(texts, size=50):
    """(document, place) of the windows that an earlier document holds too."""
    seen, out = {}, set()
    for d, t in enumerate(texts):
        w = (t or "").split()
        for k in range(len(w) - size + 1):
            if seen.setdefault(tuple(w[k : k + size]), d) != d:
                out.add((d, k))
    return out


def test_every_verbatim_window_is_reported(spark, monkeypatch):
    """A passage of two lines that documents between hold one by one, in one flush and over several tasks."""
    one, two = prose(901, 30, 5000), prose(902, 30, 5000)
    texts = [prose(903, 40) + " " + one + " " + two]
    texts += [prose(910 + k, 30) + " " + (one, two)[k % 2] + " " + prose(950 + k, 20) for k in range(12)]
    texts += [prose(980, 40) + " " + one + " " + two + " " + prose(981, 40), one + " " + two, None, ""]
    table = spark.createDataFrame([(k, t, *[None] * 6) for k, t in enumerate(texts)], SCHEMA)
    want = shared_windows(texts)
    assert {d for d, _ in want} == {13, 14}
    for flush in (substring_dedup.FLUSH, 30):
        monkeypatch.setattr(substring_dedup, "FLUSH", flush)
        for parts in (1, 5):
            spans = {}
            # min_words=50 everywhere; coalesce keeps the order of rows
            for r in substring_dedup.merged(substring_dedup.repeats(spark.createDataFrame(table.rdd.coalesce(parts), SCHEMA) if parts == 1 else table.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id"))).select("row", "spans").collect():
                spans[r.row] = [(x.start, x.end) for x in r.spans]
            found = sorted(spans.items())
            assert len(found) == 2 and all(sum(e - s for s, e in x) >= 60 for _, x in found)


def test_a_far_best_fragment_does_not_hide_a_near_one():
    """Four fragments of 15 words after a block of 500 chain as they do alone; and against brute force over all predecessors."""
    near, at = [], 600
    for gap in (0, 3, 4, 3):
        near.append((at + gap, at + gap, 15))
        at += gap + 15
    alone, after = substring_dedup.chain(near), substring_dedup.chain([(0, 0, 500), *near])
    assert len(alone) == 1 and alone[0][:2] in {c[:2] for c in after} and len(after) == 2
    rng = np.random.default_rng(4)
    for _ in range(200):
        parts = sorted({(int(a), int(b), int(n)) for a, b, n in zip(*rng.integers(0, 150, (2, 14)), rng.integers(5, 40, 14), strict=True)})
        score = [float(n) for _, _, n in parts]
        for i, (a, b, n) in enumerate(parts):
            for j, (c, d, m) in enumerate(parts[:i]):
                if c + m < a + 5 and d + m <= b + 5 and max(a - c - m, b - d - m) <= 30:
                    score[i] = max(score[i], n + score[j] - 0.2 * (a + b - c - d - 2 * m))
        last = parts[int(np.argmax(score))]
        best = [c for c in substring_dedup.chain(parts) if c[1] == last[0] + last[2] and c[3] == last[1] + last[2]]
        assert best


def test_passages_inside_a_failed_alignment():
    """60 equal words beside a region that matches by 55 % are reported; and no window of 50 words with 0.8 is left."""
    rng = np.random.default_rng(6)
    for n in range(30):
        a = rng.integers(1, 1 << 30, 260 + n).astype(np.uint32)
        b = a.copy()
        share = np.where((np.arange(len(a)) // 65) % 2 == n % 2, 0.0, 0.42)
        off = rng.random(len(a)) < share
        b[off] += 1
        got = align.passages([(a, b, -8, 8)], 50, 0.8)[0]
        left = np.ones(len(a), bool)
        for s, e, matched in got:
            assert e - s >= 50 and matched >= 0.8 * (e - s) and left[s:e].all() and matched == (~off[s:e]).sum()
            left[s:e] = False
        for s in range(len(a) - 49):
            assert not (left[s : s + 50].all() and not off[s] and not off[s + 49] and off[s : s + 50].sum() <= 10)
        assert got


def test_one_diagonal_is_the_band_of_one():
    """Sums along a diagonal find what the banded alignment finds on it."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint32)
        b = rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint32)
        d = int(rng.integers(-10, 10))
        flags, i, j = np.zeros(len(a), bool), max(0, -d), min(len(a), len(b) - d)
        if j > i:
            flags[i:j] = a[i:j] == b[i + d : j + d]
        score, matched, s, e, _, _ = align.local([(a, b, d, d)])[0]
        got = align.straight(flags)
        assert got[0] == score and (not score or got[1:] == (matched, s, e) or got[1] >= score)


def test_small_languages_are_judged(spark):
    """A language of few words gets verdicts: junk goes, clean text stays, also that of a language with one document."""
    common = {"en": ["the", "of", "and", "to", "in", "is"], "de": ["der", "die", "und", "von", "ist", "das"], "xx": ["la", "el", "que", "de", "los", "por"]}

    def clean(lang, seed):
        rng = np.random.default_rng(seed)
        return " ".join(common[lang][rng.integers(6)] if rng.random() < 0.35 else "".join(rng.choice(list("abcdeilmnorst"), 7)) for _ in range(150))

    texts = [("en", clean("en", k)) for k in range(30)] + [("de", clean("de", 100 + k)) for k in range(6)] + [("xx", clean("xx", 200))]
    rng = np.random.default_rng(9)
    junk = " ".join("".join(rng.choice(list("ABC0123456789#*$|"), 6)) for _ in range(150))
    rows = [(k, t, lang, *[None] * 5) for k, (lang, t) in enumerate([*texts, ("de", junk)])]
    got = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "quality.*").collect()}
    assert all(got[k].kept and got[k].char_distance is not None and got[k].word_distance is not None for k in range(len(texts)))
    assert not got[len(texts)].kept and not got[len(texts)].base_failed


def brute_components(sets, percent):
    """The least index reachable over links of 100 * shared >= percent * union, by lists of the sets that hold each element."""
    root, where = list(range(len(sets))), {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = {}
        for e in s:
            for j in where.setdefault(e, []):
                shared[j] = shared.get(j, 0) + 1
            where[e].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def test_units_are_resolved_exactly(monkeypatch):
    """Random units of near copies of several centres: the links join what brute force joins, with short and with long lists."""
    rng = np.random.default_rng(11)
    for turn in range(60):
        percent, rows = (85, 80, 50)[turn % 3], []
        for _ in range(rng.integers(1, 4)):
            base = rng.choice(400, rng.integers(5, 60), replace=False)
            for _ in range(rng.integers(1, 25)):
                own = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.1, 0.2])]
                rows.append(np.unique(np.concatenate((own, rng.choice(400, rng.integers(0, 6))))).astype(np.uint64))
        rows = [np.array(x, np.uint64) for x in {tuple(r.tolist()) for r in rows if len(r)}]
        monkeypatch.setattr(jaccard_join, "LONG_LIST", (2, 1000)[turn % 2])
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        found = np.concatenate(jaccard_join.resolve(np.full(len(rows), 7), np.arange(len(rows)), doc, np.concatenate(rows), percent), 1)
        want = brute_components([set(r.tolist()) for r in rows], percent)
        for a, b in found.T:
            both = len(np.intersect1d(rows[a], rows[b]))
            assert 100 * both >= percent * (len(rows[a]) + len(rows[b]) - both)
        root = list(range(len(rows)))
        for a, b in [*found.T, *found.T[::-1]] * 3:
            root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
        assert root == want


def test_large_groups_of_near_copies(spark, monkeypatch):
    """3,000 near copies, most of them apart, and 1,500 texts that share a passage alone: as brute force, whatever the size of a unit."""
    rng = np.random.default_rng(12)
    base, passage, rows = prose(700, 120, 3000).split(), prose(701, 30, 3000), []
    for k in range(3000):
        w = list(base)
        for at in rng.integers(0, len(w), k % 6):
            w[at] = f"e{rng.integers(40 if k % 2 else 10**6)}"
        rows.append(" ".join(w))
    rows += [passage + " " + prose(5000 + k, 12 + k % 90, 3000) for k in range(1500)]
    table = spark.createDataFrame([(k, t, *[None] * 6) for k, t in enumerate(rows)], SCHEMA)
    grams = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in (t.split() for t in rows)]
    want = brute_components(grams, 85)
    for unit, hot in ((jaccard_join.UNIT_SHINGLES, jaccard_join.HOT_ROWS), (20_000, 50)):
        monkeypatch.setattr(jaccard_join, "HOT_ROWS", hot)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(table.repartition(3), unit_shingles=unit).collect()}
        assert [got[k] for k in range(len(rows))] == [(len(g), c) for g, c in zip(grams, want, strict=True)]


def test_pieces_of_a_wandering_chain():
    """Pieces hold every fragment, overlap, and are narrow; a chain on few diagonals stays whole."""
    path, a, b = [], 0, 0
    for _ in range(200):
        path.append((a, b, 20))
        a, b = a + 24, b + 32
    own = substring_dedup.pieces(path, 50)
    assert len(own) > 5 and own[0][0] == 0 and own[-1][1] == path[-1][0] + 20
    assert all(x[1] - y[0] >= 100 for x, y in zip(own, own[1:], strict=False))
    assert all(abs((d - b) - (c - a)) + x <= 200 for a, b, c, d, x in ((lo, hi, p, q, x) for lo, hi, p, q, x in own))
    assert substring_dedup.pieces([(0, 0, 900), (905, 925, 900)], 50) == [(0, 1805, 0, 1825, 0)]
    rng = np.random.default_rng(3)
    first, other, places = [], [], []
    for k in range(120):  # fifteen common words, then words of the second text alone
        first += (common := rng.integers(1, 1 << 30, 15).tolist())
        places += range(len(first) - 15, len(first))
        other += common + rng.integers(1 << 30, 1 << 31, 3 * (k % 2)).tolist()
    path = [(15 * k, 15 * k + 3 * (k // 2), 15) for k in range(120)]
    found = np.zeros(len(first), bool)
    for lo, hi, p, q, off in substring_dedup.pieces(path, 50):
        down, up = sorted((0, (q - p) - (hi - lo)))
        for s, e, _ in align.passages([(np.array(first[lo:hi], np.uint32), np.array(other[p:q], np.uint32), down - off - 8, up + off + 8)], 50, 0.8)[0]:
            found[lo + s : lo + e] = True
    assert found.all()


def test_words_within_the_band():
    """Words of a that b holds on the diagonals, by looking at every place, for many pairs at once."""
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(60):
        a, b = (rng.integers(0, 12, int(rng.integers(1, 40))).astype(np.uint32) for _ in range(2))
        lo = int(rng.integers(-45, 45))
        pairs.append((a, b, lo, lo + int(rng.integers(0, 9))))
    for (a, b, lo, hi), flags in zip(pairs, align.within_band(pairs), strict=True):
        assert flags.tolist() == [any(0 <= i + d < len(b) and b[i + d] == x for d in range(lo, hi + 1)) for i, x in enumerate(a)]


def test_pairs_without_hope_are_not_aligned(monkeypatch):
    """Only what may hold a passage is aligned, and a passage's neighbourhood not once more."""
    seen, local = [], align.local
    monkeypatch.setattr(align, "local", lambda pairs: seen.append(len(pairs)) or local(pairs))
    rng = np.random.default_rng(6)
    far = []
    for _ in range(20):  # seeds of five words, far too few for a passage
        a, b = (rng.integers(1000, 1 << 31, 200).astype(np.uint32) for _ in range(2))
        for s in range(10, 190, 30):
            b[s + 2 : s + 7] = a[s : s + 5]
        far.append((a, b, -8, 8))
    a, b = (rng.integers(1000, 1 << 31, 400).astype(np.uint32) for _ in range(2))
    b[103:163] = a[100:160]
    b[120] = 1
    assert align.passages([*far, (a, b, -8, 8)], 50, 0.8) == [*[[]] * 20, [(100, 160, 59)]]
    assert sum(seen) == 1


def test_alignments_do_not_depend_on_their_batches(spark, docs, monkeypatch):  # noqa: F811
    """A chain's two sides meet though a batch ends between them."""
    got, records = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    for size in (1 << 30, 0):
        monkeypatch.setattr(substring_dedup, "ALIGN_BYTES", size)
        try:
            if not size:
                spark.conf.set(records, 3)
            got.append(sorted(map(str, substring_dedup.repeats(docs).collect())))
        finally:
            spark.conf.unset(records)
    assert got[0] == got[1] and got[0]


def test_texts_are_scanned_in_little_memory():
    """What a task holds beside its batch of texts does not come to many times the batch."""
    import tracemalloc

    import pyarrow as pa

    from methspark.llm import _text

    column = pa.array([prose(k, 1500, 4000) for k in range(40)] * 20)
    list(_text.chunks(column.slice(0, 40), _text.ALNUM))  # tables that stay
    tracemalloc.start()
    try:
        for _, _, words in _text.chunks(column, _text.ALNUM):
            words.windows(5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert column.nbytes > 6 << 20 and peak < 48 << 20


def test_ids_of_a_shard_by_parts():
    enc = packing.Encoder(*packing.public_files())
    texts = ["", "a", "x  y\n", *(prose(k, 50, 300) for k in range(9)), "", "\u4f60 \u597d<|endoftext|>", ""]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    whole = enc.batch(raw, offsets)
    for size in (1, 300, 1 << 20):
        assert all((x == y).all() for x, y in zip(enc.ids(raw, offsets, size), whole, strict=True))
