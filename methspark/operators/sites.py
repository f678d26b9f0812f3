"""Filters on calls and sites, aggregation of reads to sites, and reports by region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import finite, score_to_label
from .joins import SITE
from .metrics import site_correlation


def filter_certain_sites(truth: DataFrame, cut: float = 1.0, eps: float = 1e-5) -> DataFrame:
    return truth.where((F.col("freq") < eps) | (F.col("freq") > cut - eps))


def filter_chromosomes(df: DataFrame, chrs) -> DataFrame:
    return df.where(F.col("Chr").isin(list(chrs)))


def filter_min_read_cov(calls: DataFrame, k: int) -> DataFrame:
    """All reads of the sites with k reads or more of the tool; calls are streamed past a table of those sites."""
    enough = calls.groupBy("tool", *SITE).agg(F.count("*").alias("n")).where(F.col("n") >= k)
    return calls.join(enough.hint("shuffle_hash"), ["tool", *SITE], "left_semi")


def filter_tool_cutoffs(wide: DataFrame, cutoffs: dict[str, float]) -> DataFrame:
    for tool, cutoff in cutoffs.items():
        wide = wide.where(F.abs(tool) >= cutoff)
    return wide


def filter_finite(df: DataFrame, cols: list[str], how: str = "any") -> DataFrame:
    return df.withColumns({c: finite(F.col(c)) for c in cols}).na.drop(how=how, subset=cols)


def facet_filter(df: DataFrame, facets: dict[str, list]) -> DataFrame:
    for column, values in facets.items():
        df = df.where(F.col(column).isin(values))
    return df


def agg_read_to_site(calls: DataFrame, min_cov: int = 1, by=("tool",)) -> DataFrame:
    out = calls.groupBy(*by, *SITE).agg(F.avg("label").alias("freq"), F.count("*").alias("cov"), F.sum("label").alias("meth"))
    return out.where(F.col("cov") >= min_cov)


def agg_read_to_site_multitool(wide: DataFrame, tools: list[str], min_reads: int = 3, inclusive: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each tool's share of methylated calls by site, number of reads, and columns that the site's rows share (truth, coverage, region)."""
    label = lambda t: F.col(t) >= 0 if inclusive else F.col(t) > 0
    out = wide.groupBy(*SITE).agg(*[F.avg(F.when(F.col(t).isNotNull(), label(t).cast("int"))).alias(t) for t in tools], *[F.min(c).alias(c) for c in keep], F.count("*").alias("reads"))
    return out.where(F.col("reads") >= min_reads)


def agg_three_class_site(calls: DataFrame) -> DataFrame:
    """Shares of the labels 0, 1 and 2 at each site, and coverage."""
    return calls.groupBy(*SITE).agg(*[F.avg((F.col("label") == k).cast("int")).alias(n) for k, n in enumerate(("p_5c", "p_5mc", "p_5hmc"))], F.count("*").alias("cov"))


def expand_site_to_reads(sites: DataFrame) -> DataFrame:
    """cov rows for each site, the first meth of them methylated."""
    i = F.explode(F.sequence(F.lit(1), F.col("cov"))).alias("i")
    return sites.where("cov > 0").select(*SITE, "meth", i).select(*SITE, (F.col("i") <= F.col("meth")).cast("int").alias("label"))


def sites_report(site_calls: DataFrame, truth: DataFrame) -> DataFrame:
    """By tool: its sites, the truth's, and those in both."""
    n = truth.select(F.count("*").alias("bs_sites"))
    hit = site_calls.join(truth.select(*SITE, F.lit(1).alias("t")), SITE, "left").groupBy("tool").agg(F.count("*").alias("sites"), F.count("t").alias("joined"))
    return hit.join(F.broadcast(n)).select("tool", "sites", "bs_sites", "joined")


def raw_coverage_by_region(tagged_sites: DataFrame, cutoffs=(3,), by=("dataset", "tag")) -> DataFrame:
    return tagged_sites.groupBy(*by).agg(*[F.count_if(F.col("cov") >= c).alias(f"cov_ge_{c}") for c in cutoffs], F.count("*").alias("total"))


def positive_control_eval(site_calls: DataFrame, threshold: float = 0.2) -> DataFrame:
    """All sites are taken as methylated; a base is called at a frequency of threshold or more."""
    called = F.count_if(F.col("freq") >= threshold)
    out = site_calls.groupBy("tool").agg(F.count("*").alias("bases"), F.sum("cov").alias("calls"), F.sum("meth").alias("positive"), called.alias("called"))
    return out.withColumns({"negative": F.col("calls") - F.col("positive"), "ratio": F.col("positive") / F.col("calls"), "recall": F.col("called") / F.col("bases"), "precision": F.when(F.col("called") > 0, 1.0).otherwise(0.0)})


def agreement_partitions(pairs: DataFrame) -> DataFrame:
    """Sites by how far a tool (tool, freq) is from truth (bs_freq), with r, p and error in each part; the parts overlap."""
    d = F.abs(F.col("freq") - F.col("bs_freq"))
    names = F.array(*[F.when(c, F.lit(n)) for n, c in (("lt_0.05", d < 0.05), ("lt_0.10", d < 0.10), ("gt_0.2", d > 0.2), ("gt_0.4", d > 0.4))])
    return site_correlation(pairs.select("tool", "freq", "bs_freq", F.explode(F.array_compact(names)).alias("part")), ("tool", "part"))


def histogram_freq_cov(site_calls: DataFrame, bins: int = 10) -> DataFrame:
    """(tool, kind, bin, n): histograms of frequency in 0 to 1 and of coverage in 0 to the largest of all tools plus 1, and each tool's sites (kind sites, no bin).

    Sites are counted by bin and coverage first; all else reads that table."""
    b = F.least(F.floor(F.col("freq") * bins + 1e-9), F.lit(bins - 1)).cast("int")
    counted = site_calls.groupBy("tool", b.alias("freq_bin"), "cov").agg(F.count("*").alias("n"))
    counted = counted.withColumn("top", F.max("cov").over(Window.partitionBy(F.lit(0))) + 1)
    cov_bin = F.least(F.floor(F.col("cov") * bins / F.col("top")), F.lit(bins - 1)).cast("int")
    kinds = [("freq", F.col("freq_bin")), ("cov", cov_bin), ("sites", F.lit(None).cast("int"))]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("bin")) for k, v in kinds])).alias("x")
    return counted.select("tool", "n", rows).groupBy("tool", "x.kind", "x.bin").agg(F.sum("n").alias("n"))


def class_balance(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n, sites, share, site_share) of each value of the columns, and of all rows (facet total): rows, distinct sites, and their shares of all."""
    own = [F.col(c).cast("string").alias(f"_{k}") for k, c in enumerate(columns)]
    counted = df.groupBy(*SITE, *own).agg(F.count("*").alias("n"))  # rows are counted before each becomes one for every facet
    facets = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(f"_{k}").alias("value")) for k, c in enumerate(columns)], F.struct(F.lit("total").alias("facet"), F.lit("all").alias("value")))
    by_site = counted.select(*SITE, "n", F.explode(facets).alias("x")).groupBy(*SITE, "x.facet", "x.value").agg(F.sum("n").alias("n"))
    out = by_site.groupBy("facet", "value").agg(F.sum("n").alias("n"), F.count("*").alias("sites"))
    all_ = lambda c: F.max(F.when(F.col("facet") == "total", F.col(c))).over(Window.partitionBy(F.lit(0)))  # noqa: E731  of one row for each value
    return out.withColumns({"share": F.col("n") / all_("n"), "site_share": F.col("sites") / all_("sites")})


def long_read_portion(summary: DataFrame, cutoff: int = 10_000) -> DataFrame:
    out = summary.groupBy("dataset").agg(F.count("*").alias("reads"), F.count_if(F.col("sequence_length") > cutoff).alias("long_reads"))
    return out.withColumn("ratio", F.col("long_reads") / F.col("reads"))


def facet_counts(df: DataFrame, facets: list[str]) -> DataFrame:
    """Counts of every value of every facet, in one pass over all."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in facets])).alias("x")
    return df.select(pairs).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def region_sample_weights(df: DataFrame, column: str = "tag") -> DataFrame:
    """N / (classes * rows of the class), by class; join it to the rows."""
    out = df.groupBy(column).agg(F.count("*").alias("n"))
    total = out.select(F.sum("n").alias("total"), F.count("*").alias("classes"))
    return out.join(F.broadcast(total)).select(column, (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))


def labelled(calls: DataFrame, cutoff: float = 0.0, inclusive: bool = False) -> DataFrame:
    return calls.withColumn("label", score_to_label(F.col("Score"), cutoff, inclusive))


