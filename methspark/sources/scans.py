"""Text formats of callers, truth sets and regions, parsed into READ_CALL and SITE_CALL rows.

Every scan takes ``lines``, a DataFrame with one string column ``value`` (``spark.read.text``), and an
explicit schema; rows that do not parse, headers among them, are dropped. READ_CALL: ID, Chr, Pos
(1-based), Strand, Score, label. SITE_CALL: Chr, Pos, Strand, freq, cov, meth.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import EPS, prob_to_llr2


def fields(lines: DataFrame, sep: str = "\t", value: str | Column = "value") -> DataFrame:
    """Each line's fields as one array, p. Filters go below a projection and would split the line again for each
    condition; they stop at an explode, here of one array, so a line is split once."""
    return lines.select(F.explode(F.array(F.split(value, sep))).alias("p"))


def columns(lines: DataFrame, names: str, sep: str = "\t", least: int | None = None) -> DataFrame:
    """Splits each line into string columns; `_` skips one."""
    wanted = names.split()
    rows = fields(lines, sep).where(F.size("p") >= (least or len(wanted)))
    return rows.select(*[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(wanted) if n != "_"])


def number(name: str, kind: str = "bigint") -> Column:
    return F.expr(f"try_cast({name} as {kind})")


def chosen(df: DataFrame, chrs=None) -> DataFrame:
    return df.where(F.col("Chr").isin(list(chrs))) if chrs else df


def reads(df: DataFrame, id_: Column, chr_: Column, pos: Column, strand: Column, score: Column, label: Column, chrs=None) -> DataFrame:
    out = df.select(id_.alias("ID"), chr_.alias("Chr"), pos.cast("bigint").alias("Pos"), strand.alias("Strand"), score.alias("Score"), label.cast("int").alias("label"))
    return chosen(out.where("Pos is not null and Score is not null and label is not null and Strand in ('+', '-')"), chrs)


def sites(df: DataFrame, pos: Column, freq: Column, cov: Column, meth: Column, chrs=None, min_cov: int = 1) -> DataFrame:
    out = df.select("Chr", pos.cast("bigint").alias("Pos"), "Strand", freq.alias("freq"), cov.cast("bigint").alias("cov"), meth.cast("bigint").alias("meth"))
    return chosen(out.where(F.col("Pos").isNotNull() & (F.col("cov") >= min_cov)), chrs)


def scan_nanopolish(lines: DataFrame, chrs=None, cutoff: float = 2.0) -> DataFrame:
    """Calls of several motifs are split over every CG of the sequence, anchored 5 bases before the start; |llr| must reach cutoff for each motif."""
    df = columns(lines, "Chr Strand start _ ID llr _ _ _ motifs sequence")
    df = df.withColumns({"start": number("start"), "llr": number("llr", "double"), "motifs": number("motifs", "int")}).where(F.abs("llr") >= F.lit(cutoff) * F.col("motifs"))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length("sequence") - 1, F.lit(1))), lambda i: F.substr("sequence", i, F.lit(2)) == "CG")
    offsets = F.when(F.col("motifs") > 1, F.transform(at, lambda i: i - 6)).otherwise(F.array(F.lit(0)))
    df = df.withColumn("offset", F.explode(offsets))
    pos = F.col("start") + F.col("offset") + 1 + F.when(F.col("Strand") == "-", 1).otherwise(0)
    return reads(df, F.col("ID"), F.col("Chr"), pos, F.col("Strand"), F.col("llr"), (F.col("llr") > 0).cast("int"), chrs)


def scan_deepsignal(lines: DataFrame, chrs=None, cutoff: tuple[float, float] | None = None) -> DataFrame:
    df = columns(lines, "Chr pos Strand _ ID _ p0 p1 called", least=9).withColumns({"pos": number("pos"), "p1": number("p1", "double")})
    if cutoff:
        df = df.where((F.col("p1") <= cutoff[0]) | (F.col("p1") >= cutoff[1]))
    return reads(df, F.col("ID"), F.col("Chr"), F.col("pos") + 1, F.col("Strand"), prob_to_llr2(F.col("p1")), number("called", "int"), chrs)


def scan_tombo(lines: DataFrame, chrs=None, low: float = -1.5, high: float = 2.5) -> DataFrame:
    df = columns(lines, "Chr start _ ID stat Strand", least=6).withColumns({"start": number("start"), "stat": number("stat", "double")})
    label = F.when(F.col("stat") < low, 1).when(F.col("stat") > high, 0)
    pos = F.col("start") + 1 + F.when(F.col("Strand") == "-", 1).otherwise(0)
    return reads(df, F.col("ID"), F.col("Chr"), pos, F.col("Strand"), -F.col("stat"), label, chrs)


def scan_megalodon(lines: DataFrame, chrs=None, cutoff: float = 0.8, to_llr2: bool = False, reordered: bool = False) -> DataFrame:
    names = "Chr pos ID Strand mod can base" if reordered else "ID Chr Strand pos mod can base"
    df = columns(lines, names).where("base = 'm'").withColumns({"pos": number("pos"), "mod": number("mod", "double"), "can": number("can", "double")})
    p, score = F.exp("mod"), F.col("mod") - F.col("can")
    label = F.when(p >= cutoff, 1).when(p <= 1 - cutoff + 1e-12, 0)
    return reads(df, F.col("ID"), F.col("Chr"), F.col("pos") + 1, F.col("Strand"), score / math.log(2) if to_llr2 else score, label, chrs)


def scan_gcf52ref(lines: DataFrame, chrs=None, low: float = 0.25, high: float = 0.5) -> DataFrame:
    df = columns(lines, "Chr Strand start _ ID _ lik", least=7).withColumns({"start": number("start"), "lik": number("lik", "double")})
    p = F.pow(F.lit(10.0), F.col("lik"))
    label = F.when(p <= low, 0).when(p >= high, 1)
    pos = F.col("start") + F.when(F.col("Strand") == "-", 2).otherwise(1)
    return reads(df, F.col("ID"), F.col("Chr"), pos, F.col("Strand"), prob_to_llr2(p), label, chrs)


def scan_consensus_reads(lines: DataFrame, chrs=None, forest: bool = False) -> DataFrame:
    """Consensus output: ID, Chr, Pos, Strand, ..., label, probability; the forest form has the strand last."""
    p = F.col("p")
    n = F.size(p)
    strand, label, prob = (n - 1, n - 3, n - 2) if forest else (F.lit(3), n - 2, n - 1)
    df = fields(lines).where(n >= 6).select(p[0].alias("ID"), p[1].alias("Chr"), p[2].alias("pos"), F.get(p, strand).alias("Strand"), F.get(p, label).alias("called"), F.get(p, prob).alias("prob"))
    return reads(df, F.col("ID"), F.col("Chr"), number("pos"), F.col("Strand"), prob_to_llr2(number("prob", "double")), number("called", "int"), chrs)


def scan_uniread(lines: DataFrame, chrs=None, low: float = 0.0, high: float = 0.0) -> DataFrame:
    df = columns(lines, "ID Chr pos Strand score").withColumn("score", number("score", "double"))
    label = F.when(F.col("score") >= high, 1).when(F.col("score") <= low, 0)
    return reads(df, F.col("ID"), F.col("Chr"), number("pos"), F.col("Strand"), F.col("score"), label, chrs)


def scan_uniread_abs_cutoff(lines: DataFrame, cutoff: float, chrs=None, ids: DataFrame | None = None) -> DataFrame:
    df = columns(lines, "ID Chr pos Strand score").withColumn("score", number("score", "double")).where(F.abs("score") >= cutoff)
    out = reads(df, F.col("ID"), F.col("Chr"), number("pos"), F.col("Strand"), F.col("score"), (F.col("score") > 0).cast("int"), chrs)
    return out.join(ids.select("ID"), "ID", "left_semi").select("ID", "Chr", "Pos", "Strand", "Score", "label") if ids is not None else out


def scan_unisite(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    df = columns(lines, "Chr start _ _ _ Strand freq cov").withColumns({"start": number("start"), "freq": number("freq", "double"), "cov": number("cov")})
    return sites(df, F.col("start") + 1, F.col("freq"), F.col("cov"), F.floor(F.col("freq") * F.col("cov")), chrs, min_cov)


def scan_deepmod(lines: DataFrame, chrs=None, min_cov: int = 1, cluster: bool = False) -> DataFrame:
    """Whitespace-separated site files of 12 columns, or 13 with a clustered percentage."""
    df = columns(lines, "Chr start _ base _ Strand _ _ _ cov pct meth" + " cluster" * cluster, r"\s+")
    df = df.withColumns({c: number(c) for c in ("start", "cov", "pct", "meth")})
    freq = number("cluster", "double") / 100 if cluster else F.try_divide(F.col("meth"), F.col("cov"))
    return sites(df, F.col("start") + 1, freq, F.col("cov"), F.col("meth"), chrs, min_cov)


def scan_guppy_sites_raw(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    df = columns(lines, "Chr pos _ fm rm fc rc").withColumns({c: number(c) for c in ("pos", "fm", "rm", "fc", "rc")})
    two = F.explode(F.array(F.struct(F.lit("+").alias("Strand"), (F.col("pos") + 1).alias("p"), F.col("fm").alias("m"), F.col("fc").alias("u")), F.struct(F.lit("-").alias("Strand"), (F.col("pos") + 2).alias("p"), F.col("rm").alias("m"), F.col("rc").alias("u"))))
    df = df.select("Chr", two.alias("x")).select("Chr", "x.*").where("m + u > 0")
    return sites(df, F.col("p"), F.col("m") / (F.col("m") + F.col("u")), F.col("m") + F.col("u"), F.col("m"), chrs, min_cov)


def scan_bs_encode(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    df = columns(lines, "Chr start _ _ cov Strand _ _ _ _ pct").withColumns({"start": number("start"), "cov": number("cov"), "pct": number("pct", "double")})
    return sites(df, F.col("start") + 1, F.col("pct") / 100, F.col("cov"), F.rint(F.col("pct") / 100 * F.col("cov")), chrs, min_cov)


def scan_bs_bismark(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    df = columns(lines, "Chr pos Strand m u", least=5).withColumns({"pos": number("pos"), "m": number("m"), "u": number("u")}).where("m + u >= 1")
    return sites(df, F.col("pos"), F.col("m") / (F.col("m") + F.col("u")), F.col("m") + F.col("u"), F.col("m"), chrs, min_cov)


def scan_bs_5hmc(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    df = columns(lines, "Chr start _ level _ _ _ Strand bs oxbs").withColumns({"start": number("start"), "level": number("level", "double"), "bs": number("bs"), "oxbs": number("oxbs")})
    cov = F.greatest("bs", "oxbs")
    return sites(df, F.col("start"), F.col("level"), cov, F.rint(F.col("level") * cov), chrs, min_cov)


def scan_region_bed(lines: DataFrame, tag: str, base: int = 0) -> DataFrame:
    df = columns(lines, "Chr start stop _ _ Strand", least=3).withColumns({"start": number("start"), "stop": number("stop")}).where("start is not null and stop is not null")
    return df.select(F.lit(tag).alias("tag"), "Chr", (F.col("start") + (1 - base)).alias("start"), "stop", F.coalesce("Strand", F.lit(".")).alias("Strand"))


def unique_sites(df: DataFrame) -> DataFrame:
    """Fails the query if a site stands twice."""
    n = F.count("*")
    return df.groupBy("Chr", "Pos", "Strand").agg(*[F.when(n == 1, F.first(c)).otherwise(F.raise_error(F.lit("duplicate site"))).alias(c) for c in ("freq", "cov", "meth")])


@dataclass(frozen=True)
class CustomTool:
    """A user's own caller: column numbers, one score column (or methylated and unmethylated ones), its kind and base."""

    name: str
    id: int
    chr: int
    pos: int
    strand: int
    scores: tuple[int, ...]
    log_score: bool = True
    base: int = 0
    sep: str = "\t"


def scan_custom_tool(lines: DataFrame, tool: CustomTool, chrs=None) -> tuple[DataFrame, DataFrame]:
    """READ_CALL and SITE_CALL of a declared tool; a score above 0 is methylated."""
    p = F.col("p")
    names = {"ID": tool.id, "Chr": tool.chr, "pos": tool.pos, "Strand": tool.strand} | {f"s{k}": c for k, c in enumerate(tool.scores)}
    df = fields(lines, tool.sep).select(*[F.get(p, F.lit(c)).alias(n) for n, c in names.items()])
    s = [number(f"s{k}", "double") for k in range(len(tool.scores))]
    if len(s) == 2:
        score = s[0] - s[1] if tool.log_score else F.ln((s[0] + EPS) / (s[1] + EPS))
    else:
        score = s[0] if tool.log_score else prob_to_llr2(s[0])
    calls = reads(df, F.col("ID"), F.col("Chr"), number("pos") + (1 - tool.base), F.col("Strand"), score, (score > 0).cast("int"), chrs)
    by_site = calls.groupBy("Chr", "Pos", "Strand").agg(F.avg("label").alias("freq"), F.count("*").alias("cov"), F.sum("label").alias("meth"))
    return calls, by_site
