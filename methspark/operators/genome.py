"""Sequence and region operators: k-mers, strands from the reference, coverage to CpG sites, windows of the genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import interval_pairs
from .positions import ref_context_at_site

KMER = 17
BASES = "ACGT"


def kmer_text(x: Column, size: int = KMER) -> Column:
    """The k-mer, N for each base where there is none; another length fails the query."""
    return F.when(x.isNull(), "N" * size).when(F.length(x) == size, x).otherwise(F.raise_error(F.concat(F.lit("k-mer of a wrong length: "), x)))


def kmer_split(df: DataFrame, column: str = "k_mer", size: int = KMER) -> DataFrame:
    """One column for each base: k0, k1, ..."""
    text = kmer_text(F.col(column), size)
    return df.withColumns({f"k{i}": F.substring(text, i + 1, 1) for i in range(size)})


def kmer_onehot(df: DataFrame, column: str = "k_mer", size: int = KMER) -> tuple[DataFrame, list[str]]:
    """One 0/1 column for each place and base, all 0 for another character; and the columns' names."""
    names = [f"k{i}_{b}" for i in range(size) for b in BASES]
    text = kmer_text(F.col(column), size)
    return df.withColumns({f"k{i}_{b}": (F.substring(text, i + 1, 1) == b).cast("int") for i in range(size) for b in BASES}), names


def kmer_bits(text: Column, size: int = KMER) -> Column:
    """The 0/1 values of a k-mer (kmer_text) as one array of doubles, in the order of kmer_onehot's columns."""
    each = lambda c: F.array(*[(c == b).cast("double") for b in BASES])
    return F.flatten(F.transform(F.slice(F.split(text, ""), 1, size), each))


def infer_strand_from_ref(sites: DataFrame, chunks: DataFrame, width: int = 64) -> DataFrame:
    """Sites (Chr, Pos) with Strand (+ for C, - for G in the reference; another base fails) and the strand's trinucleotide from that base on."""
    near = ref_context_at_site(sites.select("Chr", "Pos"), chunks, 2, width)
    base, opposite = F.substring("context", 3, 1), F.translate(F.reverse(F.substring("context", 1, 3)), "ACGT", "TGCA")
    strand = F.when(base == "C", "+").when(base == "G", "-").otherwise(F.raise_error(F.concat_ws(" ", F.lit("neither C nor G at"), "Chr", F.col("Pos").cast("string"))))
    return near.select("Chr", "Pos", strand.alias("Strand"), F.when(base == "C", F.substring("context", 3, 3)).otherwise(opposite).alias("trinucleotide"))


def region_cov_to_cpg_sites(intervals: DataFrame, cpg: DataFrame) -> DataFrame:
    """CpG sites inside intervals (Chr, start0, end0, Strand, cov; 0-based, half open): Chr, Pos (1-based, of the strand's C), Strand, cov."""
    regions = intervals.select(F.struct("Strand", "cov").alias("tag"), "Chr", (F.col("start0") + 1).alias("start"), F.col("end0").alias("stop"), "Strand")
    hit = interval_pairs(cpg.select("Chr", F.col("pos_c").alias("Pos")).distinct(), regions)
    return hit.select("Chr", (F.col("Pos") + F.when(F.col("tag.Strand") == "-", 1).otherwise(0)).alias("Pos"), F.col("tag.Strand").alias("Strand"), F.col("tag.cov").alias("cov"))


def split_region_class(regions: DataFrame, column: str = "repeat_class") -> DataFrame:
    """Repeat annotation by its main class: SINE, LINE, LTR, DNA or Others."""
    first = F.substring_index(column, "/", 1)
    return regions.withColumn("part", F.when(first.isin("SINE", "LINE", "LTR", "DNA"), first).otherwise("Others"))


def bin_gc_density(df: DataFrame, column: str) -> DataFrame:
    """bin: the fifth of 0 to 100 that the value lies in (5 for 100); a value outside fails the query."""
    x = F.floor((F.floor(F.col(column) + 1e-5)) / 20).cast("int")
    return df.withColumn("bin", F.when(x.between(0, 5), x).otherwise(F.raise_error(F.lit("a density outside of 0 to 100")).cast("int")))


def filter_genomic_window(reads: DataFrame, window: str) -> DataFrame:
    """Reads (Chr, start0, end0) that touch `chr`, `chr:start` (and beyond) or `chr:start-end`."""
    name, _, span = window.partition(":")
    out = reads.where(F.col("Chr").isin(name, f"chr{name}"))
    if span:
        start, _, end = span.partition("-")
        out = out.where(F.col("end0") >= int(start))
        out = out.where(F.col("start0") <= int(end)) if end else out
    return out


def limit_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in an order of the caller's."""
    return df.orderBy(*order).limit(n)


def mock_bisulfite_read(seq: Column, methylated: Column, unmethylated: Column, strand: Column) -> Column:
    """A reference span as a bisulfite read: its CGs are N but where called methylated, and T (+) or A one base on (-) where called unmethylated. Places are 0-based in the span.

    All CGs are masked at once and the called places are put in, so a read costs its calls, not its bases."""
    shift = F.when(strand == "-", 1).otherwise(0)
    masked = F.when(strand == "-", F.replace(seq, F.lit("CG"), F.lit("CN"))).otherwise(F.replace(seq, F.lit("CG"), F.lit("NG")))
    inside = lambda c: F.filter(c, lambda p: p + shift < F.length(seq))
    put = lambda text, places, base: F.aggregate(inside(places), text, lambda t, p: F.overlay(t, base(p + shift + 1), (p + shift + 1).cast("int"), F.lit(1)))
    known = put(masked, methylated, lambda i: F.substr(seq, i.cast("int"), F.lit(1)))
    return put(known, unmethylated, lambda i: F.when(strand == "-", "A").otherwise("T"))


def reference_spans(reads: DataFrame, chunks: DataFrame, width: int = 64) -> DataFrame:
    """reads (ID, Chr, Strand, start0, end0; half open) with seq, the genome's bases of their span; reads that leave the chunks are left out.

    A read meets the chunks it covers by their number, so any length is a few rows of one key."""
    keys = ["ID", "Chr", "Strand", "start0", "end0"]
    near = reads.select(*keys).where("end0 > start0").withColumn("_at", F.explode(F.sequence(F.floor(F.col("start0") / width), F.floor((F.col("end0") - 1) / width))))
    parts = near.join(chunks.select("Chr", F.floor(F.col("chunk_start") / width).alias("_at"), F.col("seq").alias("_seq")), ["Chr", "_at"])
    whole = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_at", "_seq"))).alias("x"))
    text = F.array_join(F.transform("x", lambda y: y["_seq"]), "")
    size, skip = F.col("end0") - F.col("start0"), F.col("start0") - F.get("x", F.lit(0))["_at"] * width
    out = whole.withColumn("seq", F.substr(text, (skip + 1).cast("int"), size.cast("int")))
    return out.where((F.length("seq") == size) & (F.get("x", F.lit(0))["_at"] == F.floor(F.col("start0") / width))).select(*keys, "seq")


def call_places(calls: DataFrame, cutoff: float = 2.0) -> DataFrame:
    """For each read, chromosome and strand with confident calls: methylated and unmethylated, the 0-based starts of their CGs."""
    at = F.col("Pos") - F.when(F.col("Strand") == "-", 2).otherwise(1)
    side = lambda c: F.sort_array(F.collect_set(F.when(c, at)))
    return calls.where(F.abs("Score") >= cutoff).groupBy("ID", "Chr", "Strand").agg(side(F.col("Score") > 0).alias("methylated"), side(F.col("Score") <= 0).alias("unmethylated"))


def mock_bisulfite_reads(reads: DataFrame, calls: DataFrame, chunks: DataFrame, cutoff: float = 2.0, width: int = 64) -> DataFrame:
    """Reads with confident calls as bisulfite reads: ID, Chr, Strand, start0, end0, seq."""
    called = call_places(calls, cutoff)
    known = reads.join(called.select("ID", "Chr", "Strand").hint("shuffle_hash"), ["ID", "Chr", "Strand"], "left_semi")
    rows = reference_spans(known, chunks, width).join(called, ["ID", "Chr", "Strand"])
    inside = lambda c: F.transform(F.filter(c, lambda p: (p >= F.col("start0")) & (p < F.col("end0"))), lambda p: p - F.col("start0"))
    rows = rows.withColumns({"methylated": inside("methylated"), "unmethylated": inside("unmethylated")})
    return rows.select("ID", "Chr", "Strand", "start0", "end0", mock_bisulfite_read(F.col("seq"), F.col("methylated"), F.col("unmethylated"), F.col("Strand")).alias("seq"))
