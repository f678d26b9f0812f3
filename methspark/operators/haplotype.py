"""Haplotypes: SNV evidence of reads, their assignment, and methylation by haplotype."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import SITE, best_call_per_position


UNMAPPED, SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 0x4, 0x100, 0x200, 0x400, 0x800


def passing(min_mapq: int, supplementary: bool = False) -> Column:
    """Alignments (flag, mapq) that count: mapped, primary, not failed, not duplicate, and supplementary only if asked."""
    bad = UNMAPPED | SECONDARY | FAILED | DUPLICATE | (0 if supplementary else SUPPLEMENTARY)
    return (F.col("flag").bitwiseAND(F.lit(bad)) == 0) & (F.col("mapq") >= min_mapq)


def tag_reads_with_snvs(read_base: DataFrame, snv: DataFrame, min_mapq: int = 0, supplementary: bool = False) -> DataFrame:
    """Bases (with their read's flag) at phased SNVs with the haplotype they speak for: 1|0 puts the alternative base on haplotype 1;
    other genotypes than 1|0 and 0|1 say nothing. Bases of supplementary alignments count only if asked."""
    counts = F.lit(True) if supplementary else F.col("flag").bitwiseAND(F.lit(SUPPLEMENTARY)) == 0
    own = read_base.where((F.col("mapq") >= min_mapq) & counts).join(snv.where(F.col("gt").isin("1|0", "0|1")).select("Chr", "pos0", "ref", "alt", "gt"), ["Chr", "pos0"])
    first = F.when(F.col("gt") == "1|0", F.col("alt")).otherwise(F.col("ref"))
    hp = F.when(F.col("base") == first, 1).when((F.col("base") == F.col("ref")) | (F.col("base") == F.col("alt")), 2)
    return own.withColumn("hp", hp).where("hp is not null").select("ID", "Chr", "pos0", "base", "qual", "mapq", "hp")


def read_haplotype_evidence(tagged: DataFrame) -> DataFrame:
    item = F.struct("pos0", "qual")
    out = tagged.groupBy("ID", "hp").agg(F.count("*").alias("snvs"), F.sort_array(F.collect_list(item)).alias("x"))
    return out.select("ID", "hp", "snvs", F.array_join(F.transform("x", lambda y: F.concat_ws(":", y["pos0"].cast("string"), y["qual"].cast("string"))), ",").alias("evidence"))


def assign_haplotype(tagged: DataFrame, min_base_qual: int = 7, avg_base_qual: int = 20, hap_ratio: float = 0.75, min_snv: int = 2) -> DataFrame:
    """ID, hp: 1 or 2 where one side has more SNVs, the other at most hap_ratio of them, and no worse qualities."""
    own = tagged.where(F.col("qual") >= min_base_qual)
    side = lambda k, x: F.sum(F.when(F.col("hp") == k, x))
    out = own.groupBy("ID").agg(*[F.coalesce(side(k, F.lit(1)), F.lit(0)).alias(f"c{k}") for k in (1, 2)], *[F.coalesce(F.avg(F.when(F.col("hp") == k, F.col("qual"))), F.lit(0.0)).alias(f"m{k}") for k in (1, 2)], *[F.coalesce(side(k, (F.col("qual") >= avg_base_qual).cast("int")), F.lit(0)).alias(f"g{k}") for k in (1, 2)])

    def wins(a: int, b: int):
        return (F.col(f"c{a}") > F.col(f"c{b}")) & (F.col(f"c{b}") <= hap_ratio * F.col(f"c{a}")) & (F.col(f"c{a}") >= min_snv) & ((F.col(f"m{a}") >= F.col(f"m{b}")) | (F.col(f"g{a}") >= F.col(f"g{b}")))

    return out.select("ID", F.when(wins(1, 2), 1).when(wins(2, 1), 2).alias("hp"))


def phased_calls(calls: DataFrame, assigned: DataFrame, alignments: DataFrame) -> DataFrame:
    """Calls of assigned reads inside the read's alignment (both ends count) on its strand; of several on one position the largest |score|."""
    known = assigned.where("hp is not null")
    return _best_inside(calls, alignments.join(known, "ID"), "hp")


def _best_inside(calls: DataFrame, alignments: DataFrame, *more: str) -> DataFrame:
    """The best call of each read and position inside an alignment of the read on its strand; both ends count: tool, READ, Score and more columns of the alignment.

    Being inside is a matter of a call's place, so calls outside go before the best is chosen; they are streamed past the alignments."""
    span = alignments.select("ID", "Chr", "Strand", "start0", "end0", *more).hint("shuffle_hash")
    here = [calls[c] == span[c] for c in ("ID", "Chr", "Strand")] + [calls["Pos"] - 1 >= span["start0"], calls["Pos"] - 1 <= span["end0"]]
    best = best_call_per_position(calls.join(span, here, "left_semi"))
    return best.join(span, ["ID", "Chr", "Strand"]).where("Pos - 1 >= start0 and Pos - 1 <= end0").select("tool", "ID", *SITE, "Score", *more)


def unphased_calls(calls: DataFrame, alignments: DataFrame, min_mapq: int = 20, supplementary: bool = False) -> DataFrame:
    """The same for every read that passes the alignment filter, whatever its haplotype: tool, READ, Score."""
    return _best_inside(calls, alignments.where(passing(min_mapq, supplementary)))


def phased_frequency(phased: DataFrame) -> DataFrame:
    """All and methylated calls by haplotype and site: Chr, start (0-based; one base on for the - strand), stop, Strand, n_all, n_mod, freq."""
    start = F.col("start") + F.when(F.col("Strand") == "-", 1).otherwise(0)
    out = phased.groupBy("hp", "Chr", start.alias("start"), "Strand").agg(F.count("*").alias("n_all"), F.count_if(F.col("Score") > 0).alias("n_mod"))
    return out.withColumns({"stop": F.col("start") + 1, "freq": F.col("n_mod") / F.col("n_all")})


def hp_site_freq(calls: DataFrame, by: str = "haplotype") -> DataFrame:
    return calls.groupBy(by, *SITE).agg(F.avg("label").alias("freq"), F.count("*").alias("cov"), F.sum("label").alias("meth"))


def hp_allele_diff(freq: DataFrame, by: str = "haplotype", names=("H1", "H2")) -> DataFrame:
    """Both haplotypes side by side at each site."""
    wide = freq.groupBy(*SITE).agg(*[F.min(F.when(F.col(by) == n, F.col("freq"))).alias(f"{n}_freq") for n in names], *[F.min(F.when(F.col(by) == n, F.col("cov"))).alias(f"{n}_cov") for n in names])
    return wide.withColumn("diff", F.col(f"{names[0]}_freq") - F.col(f"{names[1]}_freq"))


def alignment_filter_counts(alignments: DataFrame, haplotags: DataFrame, min_mapq: int = 20) -> DataFrame:
    df = alignments.withColumn("ok", passing(min_mapq)).join(haplotags, "ID", "left")
    tagged = F.col("haplotype").isin("H1", "H2")
    return df.agg(F.count("*").alias("total"), F.count_if("ok").alias("passing"), F.count_if(F.col("ok") & tagged).alias("tagged"), *[F.count_if(F.col("ok") & (F.col("haplotype") == h)).alias(h.lower()) for h in ("H1", "H2")])
