"""Reports over calls, sites, regions and runs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import normal_two_sided
from .joins import SITE
from .metrics import running_totals, site_correlation

LOCATIONS = ["Promoters", "Exons", "Introns"]


def annotation_precedence(tags: DataFrame, order: list[str] | None = None, rest: str = "intergenic") -> DataFrame:
    """One location for each site: the first in the order that covers it, else `rest`. tags: SITE, tag."""
    order = order or LOCATIONS
    rank = F.coalesce(*[F.when(F.col("tag") == t, k) for k, t in enumerate(order)], F.lit(len(order)))
    names = F.array(*[F.lit(x) for x in [*order, rest]])
    return tags.groupBy(*SITE).agg(F.min(rank).alias("rank")).select(*SITE, F.get(names, F.col("rank")).alias("location"))


def dedup_reads_fastq(reads: DataFrame) -> DataFrame:
    """One record for each read id: the least, as files have no order here."""
    rest = [c for c in reads.columns if c != "read_id"]
    return reads.groupBy("read_id").agg(F.min(F.struct(*rest)).alias("x")).select("read_id", "x.*").select(*reads.columns)


def sort_report_categorical(report: DataFrame, orders: dict[str, list[str]], metric: str) -> DataFrame:
    """A report in the categories' order, then by falling metric, with its place (a report is small: one row for each group)."""
    ranks = [F.coalesce(*[F.when(F.col(c) == v, k) for k, v in enumerate(values)], F.lit(len(values))) for c, values in orders.items()]
    w = Window.orderBy(*ranks, F.desc(metric), *orders)
    return report.withColumn("place", F.row_number().over(w)).orderBy("place")


def wilcoxon_signed_rank(pairs: DataFrame, a: str, b: str, by=()) -> DataFrame:
    """By group: n (pairs that differ), w_plus, w_minus (rank sums, ties sharing their mean rank), z by the normal approximation with ties, and its two-sided p."""
    by = list(by) or ["all"]
    d = F.round(F.col(a) - F.col(b), 9)
    t = pairs.withColumn("all", F.lit(0)).select(*by, d.alias("d")).where("d <> 0").groupBy(*by, F.abs("d").alias("size")).agg(F.count("*").alias("n"), F.count_if(F.col("d") > 0).alias("up"))
    t = running_totals(t, by, F.col("size"), {"upto": F.col("n")})
    mean = F.col("upto") - (F.col("n") - 1) / 2
    ties = F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n"))
    out = t.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.col("up") * mean).alias("w_plus"), F.sum((F.col("n") - F.col("up")) * mean).alias("w_minus"), ties.alias("ties"))
    n = F.col("n").cast("double")
    out = out.withColumn("z", F.try_divide(F.col("w_plus") - n * (n + 1) / 4, F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("ties") / 48)))
    return out.select(*[c for c in by if c != "all"], "n", "w_plus", "w_minus", "z", normal_two_sided(F.col("z")).alias("p"))


def _smoothed(rows: DataFrame, by: list[str], cell: str, keep: list[str], bins: int) -> DataFrame:
    """Weights spread over cells of one axis by a Gaussian of the rows' bandwidth (null: none), cut at four bandwidths and at the grid's ends."""
    h = F.col(f"h_{cell}")
    reach = F.when(h.isNull(), 0).otherwise(F.least(F.ceil(4 * h * bins), F.lit(bins - 1)).cast("int"))
    rows = rows.withColumn("_d", F.explode(F.sequence(-reach, reach)))
    weight = F.when(h.isNull(), 1.0).otherwise(F.exp(-F.pow(F.col("_d") / bins / h, 2) / 2) / (h * math.sqrt(2 * math.pi)))
    rows = rows.withColumns({cell: F.col(cell) + F.col("_d"), "w": F.col("w") * weight}).where(h.isNull() | F.col(cell).between(0, bins - 1))
    return rows.groupBy(*by, *keep, "x", "y").agg(F.sum("w").alias("w"))


def density_grid(pairs: DataFrame, a: str, b: str, by=("tool",), bins: int = 50) -> DataFrame:
    """Kernel densities of two frequencies in 0 to 1, at the middles of cells: of both (kind xy) and of each (x and y).

    Counts by cell are smoothed one axis after the other by a Gaussian; its width is the deviation times
    n^(-1/6) for both and n^(-1/5) for one, half a cell at least. After the counts all tables are bounded by the grid."""
    by = list(by)
    cell = lambda c: F.least(F.floor(F.col(c) * bins + 1e-9), F.lit(bins - 1)).cast("int")
    own = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    moments = {f"{m}_{c}": F.sum(F.col(c) if m == "s" else F.col(c) * F.col(c)) for c in (a, b) for m in ("s", "q")}
    cells = own.groupBy(*by, cell(a).alias("x"), cell(b).alias("y")).agg(F.count("*").alias("n"), *[v.alias(k) for k, v in moments.items()])
    group = Window.partitionBy(*by)  # of one row for each cell at most
    cells = cells.withColumns({"total": F.sum("n").over(group), **{k: F.sum(k).over(group) for k in moments}})
    n = F.col("total").cast("double")
    spread = lambda c: F.sqrt(F.greatest(F.coalesce(F.try_divide(F.col(f"q_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}") / n, n - 1), F.lit(0.0)), F.lit(0.0)))
    width = lambda c, d: F.greatest(spread(c) * F.pow(n, F.lit(-1 / (d + 4))), F.lit(0.5 / bins))
    none = F.lit(None).cast("double")
    kinds = [("xy", F.col("x"), F.col("y"), width(a, 2), width(b, 2)), ("x", F.col("x"), F.lit(-1), width(a, 1), none), ("y", F.lit(-1), F.col("y"), none, width(b, 1))]
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), x.alias("x"), y.alias("y"), hx.alias("h_x"), hy.alias("h_y")) for k, x, y, hx, hy in kinds])).alias("k")
    rows = cells.select(*by, (F.col("n") / n).alias("w"), kind).select(*by, "w", "k.*")
    rows = _smoothed(rows, by, "x", ["kind", "h_y"], bins)
    rows = _smoothed(rows, by, "y", ["kind"], bins)
    at = lambda c: F.when(F.col(c) >= 0, F.col(c))
    return rows.select(*by, "kind", at("x").alias("x"), at("y").alias("y"), F.col("w").alias("density"))


#: The steps that tools need, and which tools.
STEPS = {"basecall": ("DeepSignal", "Tombo", "DeepMod", "Nanopolish"), "resquiggle": ("DeepSignal", "Tombo")}


def resource_rollup(jobs: DataFrame, steps: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """By dataset and tool: CPU seconds in all, longest wall time and largest memory; the steps that a tool needs are added to its times and their memory counts too.

    jobs: dataset, tool (or step), cpu_seconds, wall_seconds, gb."""
    steps = STEPS if steps is None else steps
    out = jobs.groupBy("dataset", "tool").agg(F.sum("cpu_seconds").alias("cpu"), F.max("wall_seconds").alias("wall"), F.max("gb").alias("gb"))
    own = out.where(~F.col("tool").isin(list(steps)))
    for step, tools in steps.items():
        base = out.where(F.col("tool") == step).select("dataset", *[F.col(c).alias(f"_{c}") for c in ("cpu", "wall", "gb")])
        need = F.col("tool").isin(list(tools))
        added = {c: F.col(c) + F.when(need, F.coalesce(f"_{c}", F.lit(0))).otherwise(0) for c in ("cpu", "wall")}
        own = own.join(base, "dataset", "left").withColumns({**added, "gb": F.when(need, F.greatest("gb", "_gb")).otherwise(F.col("gb"))}).select("dataset", "tool", "cpu", "wall", "gb")
    return own


def region_share_influence(metrics: DataFrame, distribution: DataFrame) -> DataFrame:
    """r, with p, of Macro-F1 over data sets and regions with the shares of non-singletons and of discordant sites, by tool.

    metrics: dataset, tool, tag, macro_f1; distribution: dataset, tag and the counts of the four classes."""
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(a) + F.col(b))
    shares = distribution.select("dataset", "tag", F.explode(F.array(F.struct(F.lit("non_singletons").alias("measure"), share("non_singletons", "singletons").alias("share")), F.struct(F.lit("discordant").alias("measure"), share("discordant", "concordant").alias("share")))).alias("x"))
    pairs = metrics.join(shares, ["dataset", "tag"]).select("tool", "x.measure", F.col("macro_f1").alias("freq"), F.col("x.share").alias("bs_freq"))
    return site_correlation(pairs, ("tool", "measure")).select("tool", "measure", "r", "p", "n")


def coverage_vs_accuracy(pairs: DataFrame, cutoffs: list[int]) -> DataFrame:
    """Correlation with truth and sites left, by tool and least coverage, in one pass over all. pairs: tool, cov, freq, bs_freq."""
    own = pairs.select("tool", "freq", "bs_freq", F.explode(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: F.col("cov") >= c)).alias("cutoff"))
    return site_correlation(own, ("tool", "cutoff"))


def performance_wide(reports: list[DataFrame], names: dict[str, str], tags: list[str], metric: str, datasets: list[str] | None = None, tools: list[str] | None = None) -> DataFrame:
    """Run reports (dataset, tool, tag, metric) under each other, tools renamed, one column for each tag, in the data sets' and tools' order with its place."""
    rows = reduce(DataFrame.unionByName, reports).where(F.col("tag").isin(tags))
    tool = F.coalesce(*[F.when(F.col("tool") == k, v) for k, v in names.items()], F.col("tool"))
    wide = rows.groupBy("dataset", tool.alias("tool")).agg(*[F.max(F.when(F.col("tag") == t, F.col(metric))).alias(t) for t in tags])
    return sort_report_categorical(wide, {"dataset": datasets or [], "tool": tools or []}, tags[0])
