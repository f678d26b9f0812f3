"""Classes of CpG sites as one bit mask, and the reports that count by it.

A CpG is a singleton if no other lies within the reach (the gap to the next C is `kbp` or more), else a
non-singleton; a non-singleton with certain truth is concordant if all certain labels within its reach, on
both strands, agree, else discordant. Two CpGs within the reach are always of one island, as all steps
between them are shorter, so no island has to be built: everything is one bounded window. Reports count
distinct masks first, which are few, and read their rows off that table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import SITE, interval_pairs
from .positions import TILE, haloed

CLASSES = ["Singletons", "Non-singletons", "Concordant", "Discordant"]


def c_position(pos: str = "Pos") -> Column:
    """The C of a site's CpG on the + strand."""
    return F.when(F.col("Strand") == "-", F.col(pos) - 1).otherwise(F.col(pos))


def has(mask: Column, k: int) -> Column:
    return mask.bitwiseAND(1 << k) != 0


def cpg_classes(cpg: DataFrame, certain: DataFrame, kbp: int = 10, tile: int = TILE) -> DataFrame:
    """Chr, pos_c, mask (a bit for each of CLASSES) of every CpG, by one shuffle over tiles.

    cpg: Chr, pos_c; certain: SITE, freq of sites with certain truth."""
    reach = kbp + 1
    own = cpg.select("Chr", "pos_c", F.lit(True).alias("is_cpg"), F.lit(None).cast("int").alias("label"))
    known = certain.select("Chr", c_position().alias("pos_c"), F.lit(False).alias("is_cpg"), F.when(F.col("freq") < 0.5, 0).otherwise(1).alias("label"))
    rows = haloed(own.unionAll(known), "pos_c", reach, tile).repartition("Chr", "_tile")
    one = rows.groupBy("Chr", "_tile", "pos_c", "_mine").agg(F.max("is_cpg").alias("is_cpg"), F.min("label").alias("low"), F.max("label").alias("high"))
    near = Window.partitionBy("Chr", "_tile").orderBy("pos_c").rangeBetween(-reach, reach)
    at = F.when(F.col("is_cpg"), F.col("pos_c"))
    alone, same = F.min(at).over(near) == F.max(at).over(near), F.min("low").over(near) == F.max("high").over(near)
    out = one.withColumns({"alone": alone, "same": same}).where("_mine and is_cpg")
    certain_ = F.col("low").isNotNull() & ~F.col("alone")
    bits = [F.col("alone"), ~F.col("alone"), certain_ & F.col("same"), certain_ & ~F.col("same")]
    return out.select("Chr", "pos_c", reduce(Column.bitwiseOR, [F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)]).cast("long").alias("mask"))


def site_masks(sites: DataFrame, classes: DataFrame, regions: DataFrame, tags: list[str], stranded=("rep_SINE",)) -> DataFrame:
    """sites (distinct SITE and other columns) with mask: the bits of CLASSES, then one for each tag that covers the site."""
    keys = sites.select(*SITE)
    bit = F.coalesce(*[F.when(F.col("tag") == t, 1 << (len(CLASSES) + k)) for k, t in enumerate(tags)], F.lit(0)).cast("long")
    covered = interval_pairs(keys, regions.where(F.col("tag").isin(tags)), list(stranded)).groupBy(*SITE).agg(F.bit_or(bit).alias("_tags"))
    out = sites.withColumn("pos_c", c_position()).join(classes.withColumnRenamed("mask", "_class"), ["Chr", "pos_c"], "left").join(covered, SITE, "left")
    return out.withColumn("mask", F.coalesce("_class", F.lit(0).cast("long")).bitwiseOR(F.coalesce("_tags", F.lit(0).cast("long")))).drop("pos_c", "_class", "_tags")


def bits_of(tags: list[str]) -> list[tuple[str, int]]:
    return [(n, k) for k, n in enumerate([*CLASSES, *tags])]


def _listed(counted: DataFrame, cells: list[tuple[list[Column], Column]], names: list[str]) -> DataFrame:
    """Rows (names..., n) summed from cells (values of the names, count) of a small table."""
    rows = F.explode(F.array(*[F.struct(*[v.alias(x) for v, x in zip(values, names, strict=True)], n.cast("long").alias("n")) for values, n in cells])).alias("x")
    return counted.select(rows).groupBy(*[f"x.{x}" for x in names]).agg(F.sum("x.n").alias("n"))


def region_class_table(masked: DataFrame, tags: list[str]) -> DataFrame:
    """Certain sites by class and tag, and Genome-wide: n_5c, n_5mc, n_all. masked: freq, mask."""
    counted = masked.groupBy("mask").agg(F.count_if(F.col("freq") < 1e-5).alias("n_5c"), F.count_if(F.col("freq") > 1 - 1e-5).alias("n_5mc"), F.count("*").alias("n_all"))
    rows = F.explode(F.array_append(F.filter(F.array(*[F.when(has(F.col("mask"), k), F.lit(n)) for n, k in bits_of(tags)]), lambda x: x.isNotNull()), F.lit("Genome-wide"))).alias("tag")
    return counted.select("n_5c", "n_5mc", "n_all", rows).groupBy("tag").agg(*[F.sum(c).alias(c) for c in ("n_5c", "n_5mc", "n_all")])


def region_distribution(masked: DataFrame, tags: list[str]) -> DataFrame:
    """By tag, and Genome-wide: all sites and those of the four classes."""
    counted = masked.groupBy("mask").agg(F.count("*").alias("n"))
    mask = F.col("mask")
    names = F.filter(F.array(F.lit("Genome-wide"), *[F.when(has(mask, k), F.lit(n)) for n, k in bits_of(tags)[len(CLASSES) :]]), lambda x: x.isNotNull())
    part = lambda k: F.sum(F.when(has(mask, k), F.col("n")).otherwise(0))
    columns = ("singletons", "non_singletons", "concordant", "discordant")
    return counted.select("mask", "n", F.explode(names).alias("tag")).groupBy("tag").agg(F.sum("n").alias("total"), *[part(k).alias(c) for k, c in enumerate(columns)])


def concordance_classes(certain: DataFrame, classes: DataFrame) -> DataFrame:
    """Certain sites of non-singletons, on the C's position, with whether all labels within reach agree."""
    rows = certain.select("Chr", c_position().alias("pos_c"), "Strand", F.when(F.col("freq") < 0.5, 0).otherwise(1).alias("label"), "cov")
    return rows.join(classes, ["Chr", "pos_c"]).where(has(F.col("mask"), 1)).select("Chr", "pos_c", "Strand", "label", "cov", has(F.col("mask"), 2).alias("concordant"))


def concordance_counts(certain: DataFrame, classes: DataFrame) -> DataFrame:
    """Certain sites of the concordant and of the discordant CpGs, strand by strand: class, n_5c, n_5mc."""
    rows = certain.withColumn("pos_c", c_position()).join(classes, ["Chr", "pos_c"])
    kind = F.when(has(F.col("mask"), 2), CLASSES[2]).when(has(F.col("mask"), 3), CLASSES[3])
    return rows.groupBy(kind.alias("class")).agg(F.count_if(F.col("freq") < 0.5).alias("n_5c"), F.count_if(F.col("freq") >= 0.5).alias("n_5mc")).where("class is not null")


def tool_sites(calls: DataFrame, truth: DataFrame, tools: list[str], min_cov: int = 3, truth_cov: int = 5) -> DataFrame:
    """SITE with any: a bit for each tool that calls the site; enough: for each with min_cov calls; calls_<tool>; known: the truth has truth_cov reads.

    calls: tool, SITE; truth: SITE, cov, one row each. One aggregation over both."""
    both = calls.select("tool", *SITE, F.lit(1).cast("long").alias("n")).unionByName(truth.select(F.lit(None).cast("string").alias("tool"), *SITE, F.col("cov").cast("long").alias("n")))
    count = {t: F.sum(F.when(F.col("tool") == t, F.col("n")).otherwise(0)) for t in tools}
    out = both.groupBy(*SITE).agg(*[c.alias(f"calls_{t}") for t, c in count.items()], F.coalesce(F.sum(F.when(F.col("tool").isNull(), F.col("n"))) >= truth_cov, F.lit(False)).alias("known"))
    mask = lambda least: reduce(Column.bitwiseOR, [F.when(F.col(f"calls_{t}") >= least, 1 << k).otherwise(0) for k, t in enumerate(tools)])
    return out.withColumns({"any": mask(1), "enough": mask(min_cov)})


def coverage_summary(masked: DataFrame, tools: list[str], tags: list[str], tops: tuple[int, ...] = (3, 4)) -> DataFrame:
    """(report, item, n) from tool_sites with masks.

    By tool: BG-Truth sites, all its sites, those with enough calls, those of them in the truth, all its calls, and
    sites with enough calls in each class and tag; Non-singletons are all but the singletons, whether the genome's
    islands hold them or not. Joined and Union: sites with enough calls by all and by any tool, and by all and any of
    the first tools in the list (tops: how many). Sites are counted by mask once; all rows come from that count."""
    sums = [F.sum(f"calls_{t}").alias(f"calls_{t}") for t in tools]
    counted = masked.groupBy("any", "enough", "known", "mask").agg(F.count("*").alias("n"), *sums)
    n, enough, mask = F.col("n"), F.col("enough"), F.col("mask")
    when = lambda c, x=n: F.when(c, x).otherwise(0)
    cells = []
    for k, t in enumerate(tools):
        own = has(enough, k)
        rows = [("BG-Truth", when(F.col("known"))), ("Total", when(has(F.col("any"), k))), ("Total cov", when(own)), ("Joined", when(own & F.col("known"))), ("Calls", F.col(f"calls_{t}"))]
        rows += [(name, when(own & ~has(mask, 0) if name == CLASSES[1] else own & has(mask, b))) for name, b in bits_of(tags)]
        cells += [([F.lit(t), F.lit(item)], x) for item, x in rows]
    for name, first in [("", len(tools)), *[(f"TOP{k} ", min(k, len(tools))) for k in tops]]:
        every = (1 << first) - 1
        cells += [([F.lit(f"{name}Joined"), F.lit("Total cov")], when(enough.bitwiseAND(every) == every)), ([F.lit(f"{name}Union"), F.lit("Total cov")], when(enough.bitwiseAND(every) != 0))]
    return _listed(counted, cells, ["report", "item"])
