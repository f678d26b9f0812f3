"""Further text formats and tables: site tables, annotation, variants, run logs, and the joining of many files.

As in ``scans``, lines come from ``spark.read.text`` and what does not parse is dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import duration_seconds, finite, size_gb
from ..operators.joins import SITE
from .scans import chosen, columns, number, reads, sites


def scan_deepmod_auto(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    """Site lines of 12 columns, or of 13 with a clustered percentage, told apart by their width; another width fails the query."""
    p = F.split(F.trim("value"), r"\s+")
    n = F.size(p)
    pct = F.when(n == 13, p[12]).when(n == 12, p[10]).otherwise(F.raise_error(F.concat(F.lit("neither 12 nor 13 columns: "), F.col("value"))))
    df = lines.where(F.trim("value") != "").select(p[0].alias("Chr"), p[1].alias("start"), p[5].alias("Strand"), p[9].alias("cov"), pct.alias("pct"), F.get(p, F.lit(11)).alias("meth"))
    df = df.withColumns({c: number(c) for c in ("start", "cov", "pct", "meth")})
    return sites(df, F.col("start") + 1, F.col("pct") / 100, F.col("cov"), F.col("meth"), chrs, min_cov)


def scan_megalodon_3class(lines: DataFrame, chrs=None, cutoff: float = 0.8, eps: float = 1e-5) -> DataFrame:
    """READ with label 0 (5C), 1 (5mC) or 2 (5hmC); an unmethylated call counts on m rows only; probabilities above one in sum fail the query."""
    df = columns(lines, "ID Chr Strand pos mod can base").withColumns({"pos": number("pos"), "p": F.exp(number("mod", "double")), "c": F.exp(number("can", "double"))})
    p = F.when(F.col("p") + F.col("c") > 1 + eps, F.raise_error(F.lit("probabilities above one")).cast("double")).otherwise(F.col("p"))
    label = F.when((p >= cutoff) & (F.col("base") == "m"), 1).when((p >= cutoff) & (F.col("base") == "h"), 2).when((F.col("c") >= cutoff) & (F.col("base") == "m"), 0)
    return reads(df, F.col("ID"), F.col("Chr"), F.col("pos") + 1, F.col("Strand"), F.ln((F.col("p") + eps) / (F.col("c") + eps)), label, chrs)


def scan_guppy_sites_pre(lines: DataFrame, chrs=None, min_cov: int = 1) -> DataFrame:
    """A site table of 8 columns with 1-based positions: chromosome, position, strand, motif, methylated, canonical, coverage, frequency."""
    df = columns(lines, "Chr pos Strand _ meth _ cov freq").withColumns({"pos": number("pos"), "meth": number("meth"), "cov": number("cov"), "freq": number("freq", "double")})
    return sites(df, F.col("pos"), F.col("freq"), F.col("cov"), F.col("meth"), chrs, min_cov)


def scan_bs_sitebed(lines: DataFrame, min_cov: int = 1) -> DataFrame:
    """Truth of columns 0, 2, 5, 6 and 7; one row (the least) for each site."""
    df = columns(lines, "Chr _ Pos _ _ Strand freq cov").withColumns({"Pos": number("Pos"), "freq": number("freq", "double"), "cov": number("cov")}).where("Pos is not null")
    one = df.groupBy(*SITE).agg(F.min(F.struct("freq", "cov")).alias("x")).select(*SITE, "x.*")
    return one.where(F.col("cov") >= min_cov)


def scan_modbase_calls(tags: DataFrame, cpg: DataFrame, low: float = 0.33, high: float = 0.66) -> DataFrame:
    """Calls from a table of modification tags (ID, Chr, ref_pos 0-based, Strand, mod_base, mod_score 0 to 255, is_unmapped, is_secondary) on the reference's CpG sites; Score is the probability."""
    p = F.round(F.col("mod_score") / 255, 3)
    df = tags.where("not is_unmapped and not is_secondary and mod_base <> 'h'").withColumn("p", p)
    out = reads(df, F.col("ID"), F.col("Chr"), F.col("ref_pos") + 1, F.col("Strand"), F.col("p"), F.when(F.col("p") < low, 0).when(F.col("p") >= high, 1))
    return out.join(cpg.select(*SITE), SITE, "left_semi").select(*out.columns)


def scan_tombo_stats_extract(stats: DataFrame) -> DataFrame:
    """Statistics by read (ID, Chr, Strand, pos, stat) as rows with the CpG's start: one base back on the - strand."""
    return stats.select("Chr", (F.col("pos") - F.when(F.col("Strand") == "-", 1).otherwise(0)).alias("start"), "ID", "stat", "Strand")


def scan_region_config(lines: DataFrame) -> DataFrame:
    """tag, filename, base (of the file's starts) and stranded, from comma-separated lines."""
    df = columns(lines, "tag filename base stranded", ",")
    return df.select("tag", "filename", number("base", "int").alias("base"), (F.lower("stranded") == "true").alias("stranded")).where("base is not null")


def register_region_set(regions: DataFrame, config: DataFrame) -> tuple[DataFrame, list[str]]:
    """Regions (tag, Chr, start, stop, Strand as their files have them) in 1-based coordinates by the config, and the tags that need the strand (a config is a list of files)."""
    out = regions.join(F.broadcast(config.select("tag", "base")), "tag").withColumn("start", F.col("start") + 1 - F.col("base")).drop("base")
    return out, [r["tag"] for r in config.where("stranded").select("tag").distinct().collect()]


def scan_kmer_features(lines: DataFrame, at=(4, 0, 1, 2, 6)) -> DataFrame:
    """ID, Chr, Pos (1-based), Strand and k_mer from the columns of these numbers."""
    p = F.split("value", "\t")
    df = lines.select(*[F.get(p, F.lit(k)).alias(n) for n, k in zip(("ID", "Chr", "pos", "Strand", "k_mer"), at, strict=True)])
    return df.select("ID", "Chr", (number("pos") + 1).alias("Pos"), "Strand", "k_mer").where("Pos is not null")


def scan_training_table(parts: list[DataFrame], names: list[str], numbers: list[str]) -> DataFrame:
    """The named columns of all parts; infinities count as missing, and rows with anything missing go."""
    rows = reduce(DataFrame.unionByName, [p.select(*names) for p in parts])
    return rows.withColumns({c: finite(F.col(c)) for c in numbers}).na.drop(subset=names)


def scan_phased_vcf(lines: DataFrame, window: str | None = None, margin: int = 1_000_000) -> DataFrame:
    """Phased single-base variants: Chr, pos0, ref, alt, gt; only 1|0 and 0|1; a window `chr[:start[-end]]` keeps those within margin of it."""
    df = columns(lines.where(~F.col("value").startswith("#")), "Chr pos _ ref alt _ _ _ _ sample").withColumn("pos0", number("pos") - 1)
    gt = F.substring_index("sample", ":", 1)
    base = lambda c: (F.length(c) == 1) & (F.col(c) != ".")
    out = df.where(F.col("pos0").isNotNull() & base("ref") & base("alt") & gt.isin("1|0", "0|1")).select("Chr", "pos0", F.upper("ref").alias("ref"), F.upper("alt").alias("alt"), gt.alias("gt"))
    if window:
        name, _, span = window.partition(":")
        out = out.where(F.col("Chr").isin(name, f"chr{name}"))
        if span:
            start, _, end = span.partition("-")
            out = out.where(F.col("pos0") > int(start) - margin)
            out = out.where(F.col("pos0") < int(end) + margin) if end else out
    return out


def scan_sam_strand(lines: DataFrame) -> DataFrame:
    """ID and Strand (flag 0x10: -) of alignments; of several for a read the last by place counts, as files have no order here."""
    df = columns(lines.where(~F.col("value").startswith("@")), "ID flag Chr pos").withColumns({"flag": number("flag", "int"), "pos": number("pos")}).where("flag is not null")
    one = df.groupBy("ID").agg(F.max(F.struct("Chr", "pos", "flag")).alias("x"))
    return one.select("ID", F.when(F.col("x.flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("Strand"))


def scan_sequencing_summary(lines: DataFrame) -> DataFrame:
    """dataset, read_id and sequence_length of many summaries; their headers do not parse."""
    return columns(lines, "dataset read_id sequence_length").withColumn("sequence_length", number("sequence_length")).where("sequence_length is not null")


def _splits(spark: SparkSession, path, continued: bool) -> tuple[DataFrame, DataFrame]:
    """The lines of FASTA text with their place in the split, and for each split what it takes over from those before.

    A split is a file's part that one task reads. Its lines carry the number and the name of the last header in it
    and how many bases follow that header up to the line. The second table has one row for each split."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    header = F.col("value").startswith(">")
    bases = F.when(header, "").otherwise(F.upper(F.regexp_replace("value", r"\s", "")))
    text = text.select("file", "block", "line", F.when(header, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name"), bases.alias("seq"))
    w = Window.partitionBy("file", "block").orderBy("line")
    text = text.withColumns({"part": F.count("name").over(w), "own": F.last("name", ignorenulls=True).over(w), "upto": F.sum(F.length("seq")).over(w)})
    text = text.withColumn("at", F.col("upto") - F.length("seq") - F.coalesce(F.max(F.when(F.col("name").isNotNull(), F.col("upto"))).over(w), F.lit(0)))
    ends = text.groupBy("file", "block").agg(F.max("part").alias("parts"), F.max_by("own", "line").alias("last"), F.max_by(F.col("at") + F.length("seq"), "line").alias("tail"))
    # parts of one text in their order: a file's splits, or all files of a folder by the number in their names
    number_ = F.nullif(F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"([0-9]+)", 1), F.lit("")).cast("bigint")
    order = Window.partitionBy(*([] if continued else ["file"])).orderBy(*([number_, "file"] if continued else []), "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("group", F.coalesce(F.count(F.when(F.col("parts") > 0, 1)).over(before), F.lit(0)))
    inside = Window.partitionBy(*([] if continued else ["file"]), "group").orderBy(*([number_, "file"] if continued else []), "block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("parts") > 0, F.struct("file", "block", "parts", "last", "tail")), ignorenulls=True).over(before)
    ends = ends.withColumns({"opened": opened, "between": F.coalesce(F.sum("tail").over(inside), F.lit(0))})
    carry = F.when(F.col("opened").isNotNull(), F.col("opened.tail")).otherwise(0) + F.col("between")
    contig = F.when(F.col("opened").isNotNull(), F.struct(F.col("opened.file").alias("file"), F.col("opened.block").alias("block"), F.col("opened.parts").alias("part")))
    return text, ends.select("file", "block", F.col("opened.last").alias("carried"), carry.alias("carry"), contig.alias("contig"))


def scan_fasta_chunks(spark: SparkSession, path, width: int = 64, continued: bool = False) -> DataFrame:
    """Chr, chunk_start and seq (upper case, white space left out) of FASTA files; the last chunk of a contig may be shorter.

    A record is a line, so a contig may be of any length: a split's first lines go on with the last header before the
    split, at the base where the splits before ended. continued: the files of the folder are one text, in the order of
    the numbers in their names. Lines before any header are left out; contigs of one name stay apart by their place."""
    lines, ends = _splits(spark, path, continued)
    df = lines.where("seq <> ''").join(ends, ["file", "block"])
    first = F.col("part") == 0
    own = F.struct("file", "block", "part")
    df = df.select(F.when(first, F.col("carried")).otherwise(F.col("own")).alias("Chr"), F.when(first, F.col("contig")).otherwise(own).alias("contig"), (F.col("at") + F.when(first, F.col("carry")).otherwise(0)).alias("at"), "seq").where("Chr is not null")
    df = df.withColumn("k", F.explode(F.expr(f"sequence(at div {width}, (at + length(seq) - 1) div {width})")))
    skip = F.greatest(F.col("k") * width - F.col("at"), F.lit(0))
    piece = F.struct(F.greatest("at", F.col("k") * width).alias("at"), F.substr("seq", (skip + 1).cast("int"), ((F.col("k") + 1) * width - F.greatest("at", F.col("k") * width)).cast("int")).alias("seq"))
    chunks = df.groupBy("Chr", "contig", "k").agg(F.sort_array(F.collect_list(piece)).alias("x"))
    return chunks.select("Chr", (F.col("k") * width).alias("chunk_start"), F.array_join(F.transform("x", lambda y: y["seq"]), "").alias("seq"))


def scan_trace_log(lines: DataFrame) -> DataFrame:
    """tool, dataset, reads, seconds and gb of a workflow's trace; task names are `Tool (DATASETxK)`."""
    df = columns(lines, "task_id _ _ name status _ _ _ realtime _ peak_rss")
    part = lambda k: F.regexp_extract("name", r"^(\w+) \(([A-Za-z]+)([0-9]+)K\)$", k)
    out = df.select(number("task_id").alias("task_id"), part(1).alias("tool"), part(2).alias("dataset"), part(3).alias("k"), duration_seconds(F.col("realtime")).alias("seconds"), size_gb(F.col("peak_rss")).alias("gb"))
    return out.where("tool <> '' and task_id is not null").select("task_id", "tool", "dataset", (number("k") * 1000).alias("reads"), "seconds", "gb")


def scan_job_log(blocks: DataFrame) -> DataFrame:
    """job_id, cpu_seconds, wall_seconds and gb (MB / 1000) of job reports, one text block each; times are [days-]hours:minutes:seconds."""
    text = lambda label, form: F.regexp_extract("value", f"{label}: {form}", 1)

    def seconds(label: str):
        t = lambda k: F.regexp_extract("value", rf"{label}: (?:([0-9]+)-)?([0-9]+):([0-9]+):([0-9]+)", k)
        n = lambda k: F.coalesce(F.nullif(t(k), F.lit("")).cast("bigint"), F.lit(0))
        return n(1) * 86400 + n(2) * 3600 + n(3) * 60 + n(4)

    out = blocks.select(F.nullif(text("Job ID", "([0-9]+)"), F.lit("")).cast("bigint").alias("job_id"), seconds("CPU Utilized").alias("cpu_seconds"), seconds("Job Wall-clock time").alias("wall_seconds"), F.nullif(text("Memory Utilized", "([0-9.]+) [GM]B"), F.lit("")).cast("double").alias("m"), text("Memory Utilized", "[0-9.]+ ([GM]B)").alias("unit"))
    return out.where("job_id is not null").select("job_id", "cpu_seconds", "wall_seconds", F.when(F.col("unit") == "MB", F.col("m") / 1000).otherwise(F.col("m")).alias("gb"))


def combine_batches(spark: SparkSession, paths: list[str], header: bool = False) -> DataFrame:
    """The lines of many call files under each other; with header, each file's first line goes."""
    df = spark.read.option("sep", "\u0001").option("header", header).option("enforceSchema", True).option("quote", "").schema("value string").csv(paths)
    return df


def combine_by_chromosome(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Lines of files by chromosome, of each only those that begin with its own chromosome."""
    parts = [spark.read.text(path).where(F.substring_index("value", "\t", 1) == name) for name, path in files.items()]
    return reduce(DataFrame.unionAll, parts)


def split_multi_cpg_calls(calls: DataFrame, cutoff: float = 2.0, chrs=None) -> DataFrame:
    """Calls (ID, Chr, Strand, start 0-based, llr, motifs, sequence): a call of n motifs becomes one at each CG, the first at its start, with llr / n; |llr| must reach cutoff for each motif."""
    own = calls.where(F.abs("llr") >= F.lit(cutoff) * F.col("motifs"))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length("sequence") - 1, F.lit(1))), lambda i: F.substr(F.upper("sequence"), i, F.lit(2)) == "CG")
    offsets = F.when((F.col("motifs") > 1) & (F.size(at) > 0), F.transform(at, lambda i: i - F.get(at, F.lit(0)))).otherwise(F.array(F.lit(0)))
    out = own.withColumn("offset", F.explode(offsets))
    return chosen(out.select("ID", "Chr", "Strand", (F.col("start") + F.col("offset")).alias("start"), (F.col("llr") / F.greatest("motifs", F.lit(1))).alias("llr")), chrs)


SITE_DB_TOOLS = ["BSseq", "Nanopolish", "Megalodon", "DeepSignal", "Guppy", "Tombo", "DeepMod", "METEORE"]
SITE_DB_CLASSES = ["Singleton", "Genomic_location", "CpG_location", "CG_density", "Repetitive_regions"]


def scan_site_db(lines: DataFrame) -> DataFrame:
    """The site database: place, strand, data set, frequency and coverage of truth and of seven tools, five classes of the site; empty and NA are null."""
    pairs = [f"{t}_{c}" for t in SITE_DB_TOOLS for c in ("freq", "cov")]
    names = ["Chrom", "Start", "End", "Strand", "Dataset", *pairs, *SITE_DB_CLASSES]
    df = columns(lines, " ".join(names))
    known = lambda c: F.when(~F.col(c).isin("", "NA"), F.col(c))
    types = {"Start": "bigint", "End": "bigint"} | {c: "double" if c.endswith("freq") else "bigint" for c in pairs}
    return df.select(*[F.expr(f"try_cast(`{c}` as {types[c]})").alias(c) if c in types else known(c).alias(c) for c in names]).where("Start is not null and End is not null")
