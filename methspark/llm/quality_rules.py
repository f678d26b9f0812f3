"""Quality rules by distribution divergence, in DataFrame operations only.

Each language's reference is learned from all its documents: the histogram of character classes, and
the shares of its most frequent short words. Both are blended with those of all languages together, which
count as ``PRIOR_WORDS`` further words, so a language has a reference at every size of the table. A document is rejected when the Jensen-Shannon distance
of its own histogram to its language's reference is above a threshold; each test has a minimum length,
below which it gives no verdict. Plain base rules (too few words, repeated three-word windows) come first.

All per-document work is done inside the row, so nothing but word counts, pre-aggregated in each
task, and one small reference row for each language moves. The references are broadcast up to
``MAX_LANGUAGES`` rows, counted first; beyond, they are joined.

Defined results: null text counts as empty: no words, base_failed; null languages share a reference;
repeated rows are judged alike; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import free, shared
from ._text import table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COMMON_WORDS = 24
COMMON_CHARS = 5
MIN_CHARS, MAX_CHAR_DISTANCE = 200, 0.32
MIN_SAMPLE, MAX_WORD_DISTANCE = 100, 0.31
FEW = 24
PRIOR_WORDS, PRIOR_CHARS = 100, 600
MAX_LANGUAGES = 4096
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeat_words(w: Column, n: Column) -> Column:
    """How many words lie in three-word windows that the text holds twice or more."""

    def covered(places: Column) -> Column:
        """Words in the windows that start at these places, in order."""
        step = lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"))
        return F.aggregate(places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), step, lambda acc: acc["n"])

    def few(h: Column, twice: Column) -> Column:
        places = F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i).otherwise(-1))
        return covered(F.array_remove(places, -1))

    def many(pairs: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False))
        twice = F.filter(pairs, lambda x, i: same(i, i - 1) | same(i, i + 1))
        return covered(F.sort_array(F.transform(twice, lambda x: x["i"])))

    def repeats(h: Column) -> Column:
        def sort(x: Column) -> Column:
            pairs = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x)), lambda p, q: F.when(p == q, p))
            return let(F.array_distinct(F.filter(pairs, lambda p: p.isNotNull())), either)

        def either(twice: Column) -> Column:
            long = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), many)
            return F.when(F.size(twice) <= FEW, few(h, twice)).otherwise(long)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.sort_array(h), sort))

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    hashes = let(F.transform(w, lambda x: F.xxhash64(x)), windows)
    return F.when(n < 4, 0).otherwise(let(hashes, repeats)).cast("long")


def class_counts(text: Column) -> Column:
    """Characters that are spaces, a-z, A-Z, digits, symbols, and others; each expression runs over what the last one left."""
    cuts = [SPACES, "[a-z]+", "[A-Z]+", "[0-9]+", "[#*$%&|<>]+"]

    def step(left: Column, k: int, done: list[Column]) -> Column:
        if k == len(cuts):
            sizes = [*done, F.length(left)]
            return F.array(*[(a - b).cast("double") for a, b in zip(sizes, sizes[1:], strict=False)], sizes[-1].cast("double"))
        return let(F.regexp_replace(left, cuts[k], ""), lambda x: step(x, k + 1, [*done, F.length(left)]))

    return step(text, 0, [])


def measured(text: Column) -> Column:
    """A struct of the base counts and the histogram of character classes of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def inside(w: Column) -> Column:
        n = F.size(w)
        fields = lambda c: F.struct(
            w.alias("words"),
            n.cast("long").alias("n_words"),
            (F.length(text) - F.get(c, F.lit(0))).cast("long").alias("word_chars"),
            F.get(c, F.lit(4)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(w, n).alias("n_repeat_words"),
            c.alias("classes"),
        )
        return let(class_counts(text), fields)

    return let(word_array(text), inside)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1 (the root of the divergence in bits), of two histograms that sum to one."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    return F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda acc, x: acc + x) / 2, F.lit(0.0)))


def references(docs: DataFrame, lang_col: str, text_col: str, common: int, common_chars: int) -> DataFrame:
    """lang, ref_words (the most frequent short words with a letter), ref_shares (theirs, then the rest's), ref_classes; a table without a letter has none."""
    own = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    classes = own.select("lang", class_counts(F.col("text")).alias("c")).groupBy("lang").agg(F.array(*[F.sum(F.get("c", F.lit(i))) for i in range(6)]).alias("c"))
    every = classes.agg(F.array(*[F.sum(F.get("c", F.lit(i))) for i in range(6)]).alias("every"))
    blend = lambda x, y: (x + PRIOR_CHARS * y / F.greatest(total(F.col("every")), F.lit(1.0))) / (total(F.col("c")) + PRIOR_CHARS)
    sums = classes.crossJoin(F.broadcast(every)).select("lang", F.zip_with("c", "every", blend).alias("ref_classes"))
    # all words that are too long count as one
    counts = own.select("lang", F.explode(word_array(F.col("text"))).alias("word")).groupBy("lang", F.when(F.length("word") <= common_chars, F.col("word")).alias("word")).agg(F.count("*").alias("n")).checkpoint()
    totals = counts.groupBy("lang").agg(F.sum("n").cast("double").alias("total"))
    letters = F.col("word").rlike(r"[a-zA-Z]|[^\x00-\x7F]")
    shares = counts.groupBy("word").agg(F.sum("n").alias("all")).crossJoin(F.broadcast(counts.agg(F.sum("n").alias("of")))).select("word", (PRIOR_WORDS * F.col("all") / F.col("of")).alias("prior")).where(letters).checkpoint()
    # words that a language has not come in only by their share in all: no more than the first of all can be among its best
    first = F.broadcast(shares.orderBy(F.desc("prior"), "word").limit(common))
    new = classes.select("lang").crossJoin(first).join(counts.where(letters), ["lang", "word"], "left_anti").select("lang", "word", F.col("prior").alias("n"))
    blended = counts.join(shares, "word").select("lang", "word", (F.col("n") + F.col("prior")).alias("n")).unionAll(new)
    best = blended.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("k") <= common)
    lists = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "word", "n"))).alias("top"))
    out = sums.join(totals, "lang", "left").join(lists, "lang").withColumn("total", F.coalesce("total", F.lit(0.0)) + PRIOR_WORDS)
    shares = F.transform("top", lambda x: x["n"] / F.col("total"))
    return out.select("lang", F.transform("top", lambda x: x["word"]).alias("ref_words"), F.concat(shares, F.array(1 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x))).alias("ref_shares"), "ref_classes")


def word_shares(words: Column, ref: Column, most: int) -> Column:
    """Shares of the reference's words among the text's, then the rest's."""
    n = F.size(words)

    def count(found: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(ref)), lambda k: (F.size(found) - F.size(F.array_remove(found, k))) / n)
        return F.concat(each, F.array((n - F.size(found)) / n))

    short = F.filter(words, lambda x: F.length(x) <= most)
    return let(F.array_remove(F.transform(short, lambda x: F.array_position(ref, x).cast("int")), 0), count)


def judged(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", common: int = COMMON_WORDS, common_chars: int = COMMON_CHARS, max_languages: int = MAX_LANGUAGES, quality_col: str = "quality") -> DataFrame:
    """The documents with a struct column ``quality_col``, which must be new: the base counts, base_failed, char_distance, word_distance (null: no verdict) and kept."""
    shared(docs.sparkSession)
    refs = references(docs, lang_col, text_col, common, common_chars).checkpoint()
    measures, *names = free([*docs.columns, quality_col], "measures", *refs.columns)
    refs = refs.select([F.col(c).alias(n) for c, n in zip(refs.columns, names, strict=True)])
    lang, ref_words, ref_shares, ref_classes = map(F.col, names)
    if refs.count() <= max_languages:
        refs = F.broadcast(refs)
    out = docs.withColumn(measures, measured(F.col(text_col))).join(refs, F.coalesce(F.col(lang_col), F.lit("")) == lang, "left")
    m, n = F.col(measures), F.col(measures)["n_words"]
    total = F.aggregate(m["classes"], F.lit(0.0), lambda a, x: a + x)
    classes = let(total, lambda t: F.transform(m["classes"], lambda x: x / t))
    chars = F.when(total >= MIN_CHARS, distance(classes, ref_classes))
    words = F.when(n >= MIN_SAMPLE, distance(word_shares(m["words"], ref_words, common_chars), ref_shares))
    failed = (n < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    first = F.struct(*[m[f].alias(f) for f in fields], failed.alias("base_failed"), chars.alias("char_distance"), words.alias("word_distance"))
    kept = lambda q: ~q["base_failed"] & (F.coalesce(q["char_distance"], F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (F.coalesce(q["word_distance"], F.lit(0.0)) <= MAX_WORD_DISTANCE)
    quality = let(first, lambda q: F.struct(*[q[f].alias(f) for f in [*fields, "base_failed", "char_distance", "word_distance"]], kept(q).alias("kept")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], quality.alias(quality_col))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return judged(docs).select("doc_id", "quality.*").drop("char_distance", "word_distance")
