"""Joins of calls, truth, regions and features, and set operations on sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SITE = ["Chr", "Pos", "Strand"]
READ = ["ID", *SITE]
BIN = 512
LONG_REGION_BINS = 200


def dedup_read_calls(calls: DataFrame, keys=("tool", *READ)) -> DataFrame:
    """One row for each key: the lowest score (then label) wins."""
    rest = [c for c in calls.columns if c not in keys]
    if len(rest) == 1:  # a plain column's groups are hashed, a struct's are sorted; a missing score is the lowest
        low = F.when(~F.bool_or(F.col(rest[0]).isNull()), F.min(rest[0])).alias(rest[0])
        return calls.groupBy(*keys).agg(low).select(*calls.columns)
    return calls.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_x")).select(*keys, "_x.*").select(*calls.columns)


def pivot_tools(calls: DataFrame, tools: list[str], value: str = "Score", keys=READ) -> DataFrame:
    """One column for each tool, by a single aggregation over the long form."""
    return calls.groupBy(*keys).agg(*[F.min(F.when(F.col("tool") == t, F.col(value))).alias(t) for t in tools])


def join_tools(calls: DataFrame, tools: list[str], how: str = "inner", keys=READ) -> DataFrame:
    out = pivot_tools(calls.where(F.col("tool").isin(tools)), tools, keys=keys)
    return out.dropna(subset=tools) if how == "inner" else out


def join_tools_on_sites(calls: DataFrame, tools: list[str], sites: DataFrame) -> DataFrame:
    """join_tools with all reads on the given sites, and the sites' other columns (one row for each site).

    Calls elsewhere go first: they are streamed past a table of the sites, and reads are put together where the join left them."""
    rest = [c for c in sites.columns if c not in SITE]
    own = calls.where(F.col("tool").isin(tools)).join(sites.hint("shuffle_hash"), SITE)
    return pivot_tools(own, tools, keys=[*READ, *rest])


def join_truth(df: DataFrame, truth: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(truth, SITE, how)


def semi_join_truth(calls: DataFrame, truth: DataFrame) -> DataFrame:
    """Calls on sites of the truth; they are streamed past a table of its sites."""
    return calls.join(truth.select(*SITE).distinct().hint("shuffle_hash"), SITE, "left_semi")


def truth_union_replicates(truth: DataFrame, min_cov: int = 1) -> DataFrame:
    """Coverage and methylated reads summed over replicates."""
    sums = truth.groupBy(*SITE).agg(F.sum(F.rint(F.col("freq") * F.col("cov"))).cast("bigint").alias("meth"), F.sum("cov").alias("cov"))
    return sums.where(F.col("cov") >= min_cov).select(*SITE, (F.col("meth") / F.col("cov")).alias("freq"), "cov", "meth")


def truth_consensus_replicates(one: DataFrame, two: DataFrame, freq_cut: float = 0.9, min_cov: int = 1) -> DataFrame:
    a, b = (d.where(F.col("cov") >= min_cov).select(*SITE, F.col("freq").alias(f"f{k}"), F.col("cov").alias(f"c{k}")) for k, d in ((1, one), (2, two)))
    freq = F.when((F.col("f1") < 1e-5) & (F.col("f2") < 1e-5), 0.0).when((F.col("f1") >= freq_cut) & (F.col("f2") >= freq_cut), 1.0)
    return a.join(b, SITE).select(*SITE, freq.alias("freq"), F.least("c1", "c2").alias("cov")).where("freq is not null")


def truth_consensus_counts(one: DataFrame, two: DataFrame, freq_cut: float = 0.9, min_cov: int = 1) -> DataFrame:
    """How many sites of both replicates the consensus takes as methylated and as unmethylated, and how many it leaves out."""
    both = one.select(*SITE).join(two.select(*SITE), SITE).join(truth_consensus_replicates(one, two, freq_cut, min_cov).select(*SITE, "freq"), SITE, "left")
    return both.agg(F.count_if(F.col("freq") == 1).alias("meth"), F.count_if(F.col("freq") == 0).alias("unmeth"), F.count_if(F.col("freq").isNull()).alias("unused"))


def site_matrix(site_calls: DataFrame, truth: DataFrame, tools: list[str], joined: bool = True) -> DataFrame:
    """Truth sites with frequency and coverage of each tool; joined: only sites that all tools have."""
    wide = site_calls.groupBy(*SITE).agg(*[F.min(F.when(F.col("tool") == t, F.col(c))).alias(f"{t}_{c}") for t in tools for c in ("freq", "cov")])
    out = truth.select(*SITE, F.col("freq").alias("bs_freq"), F.col("cov").alias("bs_cov")).join(wide, SITE, "left")
    return out.dropna(subset=[f"{t}_freq" for t in tools]) if joined else out


def join_features_left(preds: DataFrame, features: DataFrame, keys=SITE) -> DataFrame:
    one = features.groupBy(*keys).agg(F.min(F.struct(*[c for c in features.columns if c not in keys])).alias("_f")).select(*keys, "_f.*")
    return preds.join(one, list(keys), "left")


def _bins(lo: Column, hi: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def interval_pairs(points: DataFrame, regions: DataFrame, strand: bool = False, width: int = BIN) -> DataFrame:
    """Every (point, region) with start <= Pos <= stop (1-based, closed), as the point's columns and tag, start, stop.

    Regions are cut into bins of the position, which the join is on, so it is an equi-join that any
    partitioning holds; a region longer than LONG_REGION_BINS bins is cut into coarser ones."""
    r = regions.select("tag", F.col("Chr").alias("_chr"), "start", "stop", F.col("Strand").alias("_strand"))
    limit = width * LONG_REGION_BINS
    parts = []
    for coarse, own in ((width, r.where(F.col("stop") - F.col("start") <= limit)), (limit, r.where(F.col("stop") - F.col("start") > limit))):
        b = own.withColumn("_bin", _bins(F.col("start"), F.col("stop"), coarse))
        p = points.withColumn("_bin", F.floor(F.col("Pos") / coarse))
        match = (p["Chr"] == b["_chr"]) & (p["_bin"] == b["_bin"]) & (F.col("Pos") >= F.col("start")) & (F.col("Pos") <= F.col("stop"))
        if strand is True:
            match = match & (p["Strand"] == b["_strand"])
        elif isinstance(strand, list):
            match = match & (~F.col("tag").isin(strand) | (p["Strand"] == b["_strand"]))
        parts.append(p.join(b, match).select(*[p[c] for c in points.columns], "tag", "start", "stop"))
    return parts[0].unionAll(parts[1])


def interval_semi_join(points: DataFrame, regions: DataFrame, strand: bool = False, width: int = BIN) -> DataFrame:
    """Points in at least one region, each row once."""
    hit = interval_pairs(points.select(*SITE).distinct(), regions, strand, width).select(*SITE).distinct()
    return points.join(hit, SITE, "left_semi")


def annotate_regions_multi(sites: DataFrame, regions: DataFrame, stranded=("rep_SINE",), genome_wide: bool = True, width: int = BIN) -> DataFrame:
    """Sites with each tag that covers them, by one interval join over all tags, and once more as Genome-wide.

    A site meets its tags as one array that Genome-wide is added to. A union of the joined sites with the sites
    themselves would keep their partitioning by site, so what groups by site would follow without a shuffle; there
    adaptive execution may coalesce the sides of the union's join unequally and fail."""
    keys = sites.select(*SITE).distinct()
    pairs = interval_pairs(keys, regions, list(stranded), width)
    if not genome_wide:
        return sites.join(pairs.select(*SITE, "tag").distinct(), SITE)
    tags = pairs.groupBy(*SITE).agg(F.collect_set(F.struct("tag")).alias("_tags"))
    every = F.concat(F.coalesce("_tags", F.array().cast("array<struct<tag:string>>")), F.array(F.struct(F.lit("Genome-wide").alias("tag"))))
    out = sites.join(tags, SITE, "left").withColumn("_tag", F.explode(every))
    return out.select(*SITE, *[c for c in sites.columns if c not in SITE], F.col("_tag.tag").alias("tag"))


def join_haplotype_reads(calls: DataFrame, haplotags: DataFrame) -> DataFrame:
    return calls.join(haplotags.where(F.col("haplotype").isin("H1", "H2")).select("ID", "haplotype"), "ID")


def set_union_sites(calls: DataFrame) -> DataFrame:
    return calls.select(*SITE).distinct()


def set_intersect_sites(calls: DataFrame, tools: list[str]) -> DataFrame:
    return calls.where(F.col("tool").isin(tools)).groupBy(*SITE).agg(F.count_distinct("tool").alias("n")).where(F.col("n") == len(tools)).select(*SITE)


def set_except_sites(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*SITE).distinct().join(b.select(*SITE), SITE, "left_anti")


def tool_masks(calls: DataFrame, tools: list[str]) -> DataFrame:
    """Sites by the set of tools that have them, as a bit mask and a count."""
    mask = reduce(Column.bitwiseOR, [F.max(F.when(F.col("tool") == t, 1 << k).otherwise(0)) for k, t in enumerate(tools)])
    return calls.groupBy(*SITE).agg(mask.alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))


def venn_counts(calls: DataFrame, tools: list[str]) -> DataFrame:
    """The size of the intersection of every non-empty set of tools."""
    subsets = calls.sparkSession.range(1, 1 << len(tools)).select(F.col("id").cast("int").alias("subset"))
    masks = tool_masks(calls, tools).withColumnRenamed("mask", "m")
    both = subsets.join(F.broadcast(masks), F.col("m").bitwiseAND(F.col("subset")) == F.col("subset"), "left")
    return both.groupBy("subset").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_sites"))


def topk_joint_union(calls: DataFrame, tools: list[str], k: int) -> DataFrame:
    """Sites that all, and that any, of the k tools with most sites have."""
    totals = calls.select("tool", *SITE).distinct().groupBy("tool").agg(F.count("*").alias("n"))
    top = totals.orderBy(F.desc("n"), "tool").limit(k).select("tool")
    own = calls.select("tool", *SITE).distinct().join(F.broadcast(top), "tool").groupBy(*SITE).agg(F.count("*").alias("m"))
    return own.agg(F.count_if(F.col("m") == k).alias("joint"), F.count("*").alias("union_sites"))


def union_replicate_runs(runs: DataFrame, cap: int = 1000) -> DataFrame:
    out = runs.groupBy(*SITE).agg(F.sum("cov").alias("cov"), F.sum("meth").alias("meth")).where("cov > 0")
    return out.select(*SITE, "cov", "meth", F.floor(100 * F.col("meth") / F.col("cov")).cast("bigint").alias("pct"), F.least("cov", F.lit(cap)).cast("bigint").alias("capped"))


def chromosome_rank(name: Column) -> Column:
    """Natural order: chr1 to chr22 by number, then X, Y, M, then all other names."""
    n = F.when(F.startswith(name, F.lit("chr")), F.substring(name, 4, 1 << 30)).otherwise(name)
    other = F.when(n == "X", 1).when(n == "Y", 2).when(n.isin("M", "MT"), 3).otherwise(4)
    return F.when((n != "") & (F.translate(n, "0123456789", "") == ""), n.try_cast("bigint")).otherwise(1_000_000 + other)


def sort_distinct_natural(df: DataFrame) -> DataFrame:
    """Distinct rows in natural order: ranges of the order hold equal rows together, so rows are dealt out once."""
    order = ["_rank", "Chr", "Pos", "Strand", *[c for c in df.columns if c not in SITE]]
    dealt = df.withColumn("_rank", chromosome_rank(F.col("Chr"))).repartitionByRange(*order)
    return dealt.groupBy(*order).agg(F.count("*").alias("_n")).sortWithinPartitions(*order).select(*df.columns)


def sort_sites_natural(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in SITE]
    return df.orderBy(chromosome_rank(F.col("Chr")), "Chr", "Pos", "Strand", *rest)


def downsample_reads(calls: DataFrame, least: int, step: int = 5, first: int = 5, seed: int = 53) -> DataFrame:
    """Sites with `least` reads or more of a tool, with k of their reads in a seeded order by hash, for k = first, first + step, ... up to least: each k's rows with k."""
    site = Window.partitionBy("tool", *SITE)
    rows = calls.withColumns({"_rank": F.row_number().over(site.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "ID")), "ID")), "_all": F.count("*").over(site)})
    steps = F.filter(F.array(*[F.lit(k) for k in range(first, least + 1, step)]), lambda k: k >= F.col("_rank"))
    return rows.where(F.col("_all") >= least).withColumn("k", F.explode(steps)).drop("_rank", "_all")


def best_call_per_position(calls: DataFrame) -> DataFrame:
    """The call with the largest |score| of each read and position; of equals the larger score."""
    high, low = F.col("_high"), F.col("_low")  # plain numbers, so groups are hashed, not sorted
    best = F.when(F.abs(high) >= F.abs(low), high).otherwise(low)
    return calls.groupBy("tool", *READ).agg(F.max("Score").alias("_high"), F.min("Score").alias("_low")).select("tool", *READ, best.alias("Score"))
