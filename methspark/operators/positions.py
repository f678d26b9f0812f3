"""Operators over neighbouring positions of a chromosome.

Windows whose frame is bounded are partitioned by (Chr, tile), each tile with a halo of its neighbours'
rows; runs and sums that may go on for ever are computed inside tiles and joined over a small table of
one row for each tile, so no task holds a chromosome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 1_000_000
#: Stands for a base that no chunk has.
GAP = "\0"


def haloed(df: DataFrame, pos: str, halo: int, tile: int) -> DataFrame:
    """Each row in its own tile (mine) and in any other whose edge is within halo."""
    tiles = F.array_distinct(F.transform(F.array(F.lit(0), F.lit(-halo), F.lit(halo)), lambda d: F.floor((F.col(pos) + d) / tile)))
    out = df.withColumn("_tile", F.explode(tiles))
    return out.withColumn("_mine", F.col("_tile") == F.floor(F.col(pos) / tile))


def running_id(df: DataFrame, order: list[str], is_start, tile_of: Column, by: list[str]) -> DataFrame:
    """Numbers runs within `by`: a row opens one where is_start(previous row's columns struct) holds.

    is_start gets the previous row (null for the first) as a Column and returns a Column."""
    cols = df.columns
    df = df.withColumn("_tile", tile_of)
    inside = Window.partitionBy(*by, "_tile").orderBy(*order)
    last = df.groupBy(*by, "_tile").agg(F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("_last"))
    ahead = last.select(*by, "_tile", F.lag("_last").over(Window.partitionBy(*by).orderBy("_tile")).alias("_carry"))
    df = df.join(ahead, [*by, "_tile"])
    me = F.struct(*order, *[c for c in cols if c not in order])
    df = df.withColumn("_prev", F.coalesce(F.lag(me).over(inside), F.col("_carry")))
    df = df.withColumn("_new", F.when(F.col("_prev").isNull() | is_start(F.col("_prev")), 1).otherwise(0))
    sums = df.groupBy(*by, "_tile").agg(F.sum("_new").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select(*by, "_tile", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    run = F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_offset")
    return df.join(offset, [*by, "_tile"]).select(*cols, run.alias("run"))


def singleton_islands(cpg: DataFrame, kbp: int = 10, tile: int = TILE) -> DataFrame:
    """CpGs (Chr, pos_c) closer than kbp chain into islands: Chr, start, stop, cpgs, singleton."""
    unique = cpg.select("Chr", "pos_c").distinct()
    runs = running_id(unique, ["pos_c"], lambda prev: F.col("pos_c") - (prev["pos_c"] + 2) >= kbp, F.floor(F.col("pos_c") / tile), ["Chr"])
    out = runs.groupBy("Chr", "run").agg(F.min("pos_c").alias("start"), (F.max("pos_c") + 1).alias("stop"), F.count("*").alias("cpgs"))
    return out.select("Chr", "start", "stop", "cpgs", (F.col("cpgs") == 1).alias("singleton"))


def merge_intervals(intervals: DataFrame, tile: int = TILE) -> DataFrame:
    """Overlapping or touching intervals of one strand merged (closed coordinates).

    The running maximum of the ends is carried over tiles of the start."""
    df = intervals.select("Chr", "Strand", "start", "stop").withColumn("_tile", F.floor(F.col("start") / tile))
    by = ["Chr", "Strand"]
    tops = df.groupBy(*by, "_tile").agg(F.max("stop").alias("_top"))
    carry = tops.select(*by, "_tile", F.max("_top").over(Window.partitionBy(*by).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    inside = Window.partitionBy(*by, "_tile").orderBy("start", "stop")
    reach = F.greatest(F.max("stop").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    df = df.join(carry, [*by, "_tile"]).withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    sums = df.groupBy(*by, "_tile").agg(F.sum("_new").alias("_n"))
    offset = sums.select(*by, "_tile", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    run = F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_offset")
    return df.join(offset, [*by, "_tile"]).withColumn("run", run).groupBy(*by, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def genome_coverage(alignments: DataFrame, tile: int = TILE) -> DataFrame:
    """Non-zero depth runs (0-based, half open) of alignments by strand; equal neighbours are one run."""
    by = ["Chr", "Strand"]
    events = alignments.select(*by, F.explode(F.array(F.struct(F.col("start0").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end0").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    events = events.groupBy(*by, "e.at").agg(F.sum("e.d").alias("d")).where("d <> 0").withColumn("_tile", F.floor(F.col("at") / tile))
    sums = events.groupBy(*by, "_tile").agg(F.sum("d").alias("_n"), F.min("at").alias("_first"))
    over = Window.partitionBy(*by).orderBy("_tile")
    offset = sums.select(*by, "_tile", F.coalesce(F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"), F.lead("_first").over(over).alias("_next"))
    inside = Window.partitionBy(*by, "_tile").orderBy("at")
    out = events.join(offset, [*by, "_tile"])
    out = out.withColumns({"depth": F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_offset"), "stop": F.coalesce(F.lead("at").over(inside), F.col("_next"))})
    return out.where("depth > 0").select(*by, F.col("at").alias("start"), "stop", "depth")


def read_sessions(reads: DataFrame, gap: int = 100_000) -> DataFrame:
    """Rows (ID, Strand, Chr, start0) of one read stay one group while starts are less than gap apart."""
    w = Window.partitionBy("ID", "Chr", "Strand").orderBy("start0")
    new = F.when(F.col("start0") - F.lag("start0").over(w) < gap, 0).otherwise(1)
    return reads.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def cpg_scan_genome(chunks: DataFrame, width: int = 64) -> DataFrame:
    """Every CG start (0-based) inside the chunks and over their borders."""
    nxt = chunks.select("Chr", (F.col("chunk_start") - width).alias("chunk_start"), F.substring("seq", 1, 1).alias("ahead"))
    df = chunks.join(nxt, ["Chr", "chunk_start"], "left").withColumn("s", F.concat("seq", F.coalesce("ahead", F.lit(""))))
    at = F.filter(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr("s", i, F.lit(2)) == "CG")
    return df.select("Chr", "chunk_start", F.explode(at).alias("i")).select("Chr", (F.col("i") - 1 + F.col("chunk_start")).alias("start"))


def ref_context_at_site(sites: DataFrame, chunks: DataFrame, n: int = 5, width: int = 64) -> DataFrame:
    """The n bases on both sides of each position (1-based) that lies in a chunk; null where the genome is not there.

    Each chunk gets n bases of its neighbours first, so a site meets one row and sites are neither sorted nor grouped."""
    reach = -(-n // width)
    own = F.floor(F.col("chunk_start") / width)
    near = chunks.select("Chr", own.alias("_own"), F.rpad("seq", width, GAP).alias("_seq"), F.explode(F.sequence(own - reach, own + reach)).alias("_at"))
    parts = [F.max(F.when(F.col("_own") == F.col("_at") + k, F.col("_seq"))) for k in range(-reach, reach + 1)]
    text = F.concat(*[F.coalesce(x, F.lit(GAP * width)) for x in parts])
    around = near.groupBy("Chr", "_at").agg(parts[reach].alias("_mid"), F.substring(text, reach * width - n + 1, width + 2 * n).alias("_text")).where("_mid is not null").drop("_mid")
    p = F.col("Pos") - 1
    rows = sites.withColumn("_at", F.floor(p / width)).join(around.hint("shuffle_hash"), ["Chr", "_at"])
    context = F.substr("_text", (p - F.col("_at") * width + 1).cast("int"), F.lit(2 * n + 1))
    return rows.select(*sites.columns, F.when(~F.contains(context, F.lit(GAP)), context).alias("context"))


def cluster_neighbor_features(sites: DataFrame, nb: int = 25, tile: int = TILE) -> DataFrame:
    """Sites (SITE, freq) with the features of the cluster model: partner_freq (the CpG's other strand, 0 if absent),
    neighbors (other positions within nb bases, the partner's left out) and h0 to h10, the share of neighbours whose
    frequency is nearest to 0, 0.1, ... 1, to three places. A position with sites on both strands counts as its + site."""
    strand = lambda s: F.min(F.when(F.col("Strand") == s, F.col("freq")))
    one = haloed(sites, "Pos", nb, tile).repartition("Chr", "_tile").groupBy("Chr", "_tile", "Pos", "_mine").agg(strand("+").alias("plus"), strand("-").alias("minus"))
    one = one.withColumn("bin", F.floor(F.coalesce("plus", "minus") / 0.1 + 0.5))
    w = Window.partitionBy("Chr", "_tile").orderBy("Pos")
    near, ahead, behind = w.rangeBetween(-nb, nb), w.rangeBetween(1, 1), w.rangeBetween(-1, -1)
    hits = {f"h{k}": F.count_if(F.col("bin") == k).over(near) for k in range(11)}
    one = one.withColumns({**hits, "all": F.count("*").over(near), "other_minus": F.max("minus").over(ahead), "other_plus": F.max("plus").over(behind), "bin_ahead": F.max("bin").over(ahead), "bin_behind": F.max("bin").over(behind)})
    own = [F.struct(F.lit("+").alias("Strand"), F.col("plus").alias("freq"), F.col("other_minus").alias("partner"), F.col("bin_ahead").alias("gone")), F.struct(F.lit("-").alias("Strand"), F.col("minus").alias("freq"), F.col("other_plus").alias("partner"), F.col("bin_behind").alias("gone"))]
    rows = one.where("_mine").withColumn("s", F.explode(F.array(*own))).where("s.freq is not null")
    n = F.col("all") - 1 - F.when(F.col("s.gone").isNull(), 0).otherwise(1)
    count = lambda k: F.col(f"h{k}") - F.when(F.col("bin") == k, 1).otherwise(0) - F.when(F.col("s.gone") == k, 1).otherwise(0)
    share = lambda k: F.bround(F.coalesce(F.try_divide(count(k), n), F.lit(0.0)), 3)
    return rows.select("Chr", "Pos", "s.Strand", "s.freq", F.coalesce("s.partner", F.lit(0.0)).alias("partner_freq"), n.alias("neighbors"), *[share(k).alias(f"h{k}") for k in range(11)])
