"""Every stage of the pipeline, on what the stage before kept, against a brute-force version; awkward columns; empty tables."""

import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from methspark.llm import packing, quality_rules, substring_dedup

from .test_llm import LOWER, corpus, prose, words
from .test_whole import brute_components, shared_windows

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, row long, `_row` long, spans string, `_spans` int, lang_ string, ref_words string, measures int, id string, node long, hit_words string"
ALNUM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def table():
    """The awkward texts, near copies, passages in several texts, junk in each language, a very long text; clashing columns."""
    texts = [r[1] for r in corpus()]
    base = prose(31, 200).split()
    for k in range(12):
        w = list(base)
        w[(k * 17) % 190] = f"x{k}"
        texts.append(" ".join(w))
    shared = prose(32, 80, 9000)
    texts += [prose(33 + k, 60 + 9 * k, 9000) + " " + shared + " " + prose(60 + k, 70, 9000) for k in range(5)]
    texts += ["~ ^ " * 300, "12 34 56 " * 200, prose(80, 20_000, 50_000), prose(7, 30) + " tail " + prose(81, 300)]
    return [(k, t, ["en", None, "de", "xx"][k % 4], ["a", "b"][k % 2], len(t or ""), "q", k, k, "s", 1, "l", "r", 2, "i", 3, "h") for k, t in enumerate(texts)]


def brute_quality(rows):
    """doc_id of the rows kept: base rules, then both Jensen-Shannon distances to the language's blended reference."""
    kinds = [r"[\x20\x09-\x0D]", "[a-z]", "[A-Z]", "[0-9]", "[#*$%&|<>]"]

    def classes(t):
        found = [len(re.findall(k, t)) for k in kinds]
        return [*found, len(t) - sum(found)]

    def distance(p, q):
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)) / 2))

    langs, counts = defaultdict(lambda: [0] * 6), defaultdict(Counter)
    for _, t, lang, *_ in rows:
        langs[lang or ""] = [a + b for a, b in zip(langs[lang or ""], classes(t or ""), strict=True)]
        counts[lang or ""].update(w if len(w) <= quality_rules.COMMON_CHARS else None for w in words(t, False))
    every, total = [sum(c) for c in zip(*langs.values(), strict=True)], sum(counts.values(), Counter())
    of = sum(total.values())
    prior = {w: quality_rules.PRIOR_WORDS * n / of for w, n in total.items() if w is not None and re.search(r"[a-zA-Z]|[^\x00-\x7F]", w)}
    kept = []
    for r in rows:
        lang, w, t = r[2] or "", words(r[1], False), r[1] or ""
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        times = Counter(grams)
        repeat = len({k + d for k, g in enumerate(grams) if times[g] > 1 for d in range(3)})
        if len(w) < 50 or 100 * repeat > 50 * len(w):
            continue
        c = classes(t)
        reference = [(x + quality_rules.PRIOR_CHARS * y / max(1, sum(every))) / (sum(langs[lang]) + quality_rules.PRIOR_CHARS) for x, y in zip(langs[lang], every, strict=True)]
        if sum(c) >= quality_rules.MIN_CHARS and distance([x / sum(c) for x in c], reference) > quality_rules.MAX_CHAR_DISTANCE:
            continue
        best = sorted(((counts[lang][x] + p, x) for x, p in prior.items()), key=lambda y: (-y[0], y[1]))[: quality_rules.COMMON_WORDS]
        n = sum(counts[lang].values()) + quality_rules.PRIOR_WORDS
        shares, own = [x / n for x, _ in best], Counter(w)
        mine = [own[x] / len(w) for _, x in best]
        if len(w) >= quality_rules.MIN_SAMPLE and distance([*mine, 1 - sum(mine)], [*shares, 1 - sum(shares)]) > quality_rules.MAX_WORD_DISTANCE:
            continue
        kept.append(r[0])
    return kept


def brute_decontamination(text, items):
    if text is None:
        return None
    low, places = text.translate(LOWER), []
    places = [m.span() for m in ALNUM_WORD.finditer(low)]
    w, hit = [low[a:b] for a, b in places], set()
    for item in items:
        v = ALNUM_WORD.findall((item or "").translate(LOWER))
        n = min(10, len(v))
        grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
        hit |= {k + d for k in range(len(w) - n + 1) if n and tuple(w[k : k + n]) in grams for d in range(n)}
    out, at = "", 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out += text[at : places[k][0]]
        at = places[k][1]
    return out + text[at:]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(table(), SCHEMA).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, prose(7, 30)), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_in_order(spark, folder):
    docs, names = spark.read.parquet(f"{folder}/documents.parquet"), None
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            break
        assert out.columns == docs.columns and out.schema == docs.schema
        out.write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        got = sorted(tuple(r) for r in docs.collect())
        old = {r[0]: r for r in rows}
        # other columns are as they were, and n_chars is the length of the text left
        assert all(r[2:4] + r[5:] == old[r[0]][2:4] + old[r[0]][5:] and (r[1] == old[r[0]][1] or r[4] == len(r[1])) for r in got)
        if name == "quality rules":
            assert [r[0] for r in got] == brute_quality(rows) and 3 < len(got) < len(rows)
        elif name == "near duplicates":
            grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for w in (words(r[1]) for r in rows)]
            kinds = {}
            for r, c in zip(rows, brute_components(grams, 80), strict=True):
                kinds.setdefault(c, set()).add(r[0])
            kept = {r[0] for r in got}
            assert all(len(kept & k) == 1 for k in kinds.values()) and any(len(k) > 5 for k in kinds.values())
        elif name == "substring dedup":
            order = [r[0] for r in before.collect()]  # the places: files, then rows
            text = [ALNUM_WORD.findall(old[k][1].translate(LOWER)) for k in order]
            spans = {}
            for r in substring_dedup.repeats(before).collect():
                a, b = order.index(r.doc_id), order.index(r.partner_id)
                assert b < a and r.end - r.start >= 50 and 0.8 * (r.end - r.start) <= r.matched
                assert longest_common(text[a][r.start : r.end], text[b]) >= r.matched
                spans.setdefault(a, set()).update(range(r.start, r.end))
            for a, k in shared_windows([" ".join(t) for t in text]):
                assert set(range(k, k + 50)) <= spans[a]
            new = {r[0]: r[1] for r in got}
            for a, k in enumerate(order):
                left = [x for n, x in enumerate(text[a]) if n not in spans.get(a, ())]
                assert ALNUM_WORD.findall(new.get(k, "").translate(LOWER)) == left
            assert spans
        else:
            want = {r[0]: brute_decontamination(r[1], [prose(7, 30), None, ""]) for r in rows}
            assert {r[0]: r[1] for r in got} == want and want != {r[0]: r[1] for r in rows}
        rows = got
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(packing.public_files()[0]), {}
    for p in packing.pack(docs, *packing.public_files(), with_ids=True).collect():
        pieces.setdefault(p.doc_id, []).append((p.start, p.ids))
    assert {k: [x for _, ids in sorted(v) for x in ids] for k, v in pieces.items()} == {r[0]: [*whole.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    assert sorted((r.doc_id, r.start) for r in corpus_pipeline.run(spark, folder).collect()) == sorted((k, s) for k, v in pieces.items() for s, _ in v)


def test_other_stages_keep_null_texts_and_repeated_rows(spark, folder):
    """Each stage but the first on the table as it is, with nulls, empty texts and repeated rows; the places of unstored rows are kept too."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    twice = docs.unionAll(docs).repartition(5)
    one = STAGES["near duplicates"](spark, twice, folder)
    texts = [r.text for r in one.collect()]
    assert one.columns == docs.columns and sum(t is None for t in texts) == 2 * sum(r[1] is None for r in table())
    kept = Counter(" ".join(words(t)) for t in texts if words(t))
    assert kept and max(kept.values()) == 1
    left = STAGES["substring dedup"](spark, twice, folder)
    assert left.columns == docs.columns and max(Counter(r.doc_id for r in left.collect() if r.n_chars > 500).values()) == 1
    assert STAGES["decontamination"](spark, twice, folder).count() == 2 * len(table())
    assert sum(r.start == 0 for r in STAGES["packing"](spark, twice, folder).collect()) == 2 * len(table())


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for stage in STAGES.values():
        assert stage(spark, docs, folder).count() == 0
