"""Formatted tables for downstream tools, and their writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import SITE, chromosome_rank


def fixed(x: Column, places: int = 3) -> Column:
    """A plain decimal text with a fixed number of places."""
    return F.round(x, places).cast(f"decimal(18,{places})").cast("string")


def export_read_unified(calls: DataFrame, dedup: bool = True) -> DataFrame:
    out = calls.select("ID", "Chr", "Pos", "Strand", "Score")
    return out.distinct() if dedup else out


def export_site_unified(sites: DataFrame) -> DataFrame:
    """BED8, 0-based start."""
    return sites.select("Chr", (F.col("Pos") - 1).alias("start"), F.col("Pos").alias("stop"), F.lit(".").alias("name"), F.lit(".").alias("score"), "Strand", "freq", "cov")


def export_single_site_bed(sites: DataFrame) -> DataFrame:
    return sites.select("Chr", (F.col("Pos") - 1).alias("start"), F.col("Pos").alias("stop"), F.lit(".").alias("name"), F.lit(".").alias("score"), "Strand")


def export_read_preds(calls: DataFrame) -> DataFrame:
    """A site's labels, sorted, as one text."""
    labels = F.array_join(F.transform(F.sort_array(F.collect_list("label")), lambda x: x.cast("string")), ",")
    return calls.groupBy(*SITE).agg(labels.alias("labels"), F.count("*").alias("cov"))


def export_site_class_freq(classes: DataFrame, columns=("p_5c", "p_5mc")) -> DataFrame:
    return classes.select(*SITE, *[fixed(F.col(c)).alias(c) for c in columns], "cov")


def export_bedgraph(sites: DataFrame, signal: str = "freq", min_cov: int = 1) -> DataFrame:
    """Distinct signal rows in natural order."""
    out = sites.where(F.col("cov") >= min_cov).select("Chr", (F.col("Pos") - 1).alias("start"), F.col("Pos").alias("stop"), F.col(signal).alias("signal")).distinct()
    return out.orderBy(chromosome_rank(F.col("Chr")), "Chr", "start", "signal")


def export_methylkit(sites: DataFrame) -> DataFrame:
    strand = F.when(F.col("Strand") == "+", "F").otherwise("R")
    return sites.where("cov > 0").select(F.concat_ws(".", "Chr", F.col("Pos").cast("string")).alias("chrBase"), "Chr", F.col("Pos").alias("base"), strand.alias("strand"), F.col("cov").alias("coverage"), (100 * F.col("freq")).alias("freqC"), (100 - 100 * F.col("freq")).alias("freqT"))


def export_ucsc_bed(sites: DataFrame, scale: int = 100, score_type: str = "int") -> DataFrame:
    """BED6 with the scaled frequency as a whole number, or as a text of three decimals."""
    value = F.col("freq") * scale
    score = F.floor(value + 1e-9).cast("bigint") if score_type == "int" else fixed(value)
    return sites.select("Chr", (F.col("Pos") - 1).alias("start"), F.col("Pos").alias("stop"), F.lit(".").alias("name"), score.alias("score"), "Strand")


def export_methylkit_from_freq(freq: DataFrame) -> DataFrame:
    """As export_methylkit, from a phased frequency table; the base is its end."""
    return export_methylkit(freq.select("Chr", F.col("stop").alias("Pos"), "Strand", F.col("n_all").alias("cov"), "freq"))


def export_tss_5hmc_bed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Chosen columns, with 1-based start and stop moved one base back."""
    back = {"start": F.col("start") - 1, "stop": F.col("stop") - 1}
    return df.select(*[back[c].alias(c) if c in back else F.col(c) for c in columns])


def export_curve_points(rows: DataFrame, path: str | None = None) -> DataFrame:
    """y_true, y_pred and y_score by tool and tag; stored in folders of both if a path is given."""
    out = rows.select("tool", "tag", "y_true", "y_pred", "y_score")
    if path:
        out.write.mode("overwrite").partitionBy("tool", "tag").parquet(path)
    return out


def export_keyset(sites: DataFrame) -> DataFrame:
    """Distinct keys; write_text sorts them."""
    return sites.select(F.concat_ws("_", "Chr", F.col("Pos").cast("string"), "Strand").alias(KEY)).distinct()


def export_read_grouped_bed(calls: DataFrame, cutoff: float = 1.5) -> DataFrame:
    """One row for each read, chromosome and strand with its confident calls' scores and positions."""
    pos = F.col("Pos") - F.when(F.col("Strand") == "-", 2).otherwise(1)
    item = F.when(F.abs("Score") >= cutoff, F.struct(pos.alias("p"), F.col("Score").alias("s")))
    g = calls.groupBy("ID", "Chr", "Strand").agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("stop"), F.sort_array(F.collect_list(item)).alias("x"))
    text = lambda f: F.when(F.size("x") == 0, "NA").otherwise(F.array_join(F.transform("x", f), ","))
    return g.select("ID", "Chr", "Strand", "start", "stop", text(lambda y: fixed(y["s"])).alias("llrs"), text(lambda y: y["p"].cast("string")).alias("positions"))


def export_dss_input(sites: DataFrame, min_cov: int = 1) -> DataFrame:
    return sites.where(F.col("cov") >= min_cov).select("Chr", F.col("Pos").alias("pos"), F.col("cov").alias("N"), F.rint(F.col("cov") * F.col("freq")).cast("bigint").alias("X"))


def export_dss_input_stranded(sites: DataFrame, min_cov: int = 1) -> DataFrame:
    """Both strands of a CpG summed on the C's position."""
    c = F.when(F.col("Strand") == "-", F.col("Pos") - 1).otherwise(F.col("Pos"))
    return sites.where(F.col("cov") >= min_cov).groupBy("Chr", c.alias("pos")).agg(F.sum("cov").alias("N"), F.sum("meth").alias("X"))


def export_corr_table(matrix: DataFrame, tools: list[str]) -> DataFrame:
    """Truth and tools side by side; frequencies with three decimals, empty where absent."""
    text = lambda c, f: F.coalesce(f(F.col(c)), F.lit("")).alias(c)
    cols = [x for t in ("bs", *tools) for x in (text(f"{t}_freq", fixed), text(f"{t}_cov", lambda x: x.cast("string")))]
    return matrix.select(*SITE, *cols)


KEY = "key"


def natural_keys(columns: list[str]) -> dict[str, Column]:
    """The natural order's columns by name: chromosomes in natural order, then place, strand and the other columns; a key like chr1_5_+ as its parts."""
    if KEY in columns:
        name = F.regexp_extract(KEY, r"^(.*)_([0-9]+)_([+-])$", 1)
        return {"_rank": chromosome_rank(name), "_name": name, "_place": F.regexp_extract(KEY, r"_([0-9]+)_[+-]$", 1).cast("bigint"), KEY: F.col(KEY)}
    first = ["Chr", *[c for c in ("Pos", "start", "Strand") if c in columns]]
    return {"_rank": chromosome_rank(F.col("Chr")), **{c: F.col(c) for c in (*first, *[c for c in columns if c not in first])}}


def natural_order(columns: list[str]) -> list[Column]:
    return list(natural_keys(columns).values())


def write_text(df: DataFrame, path: str, sort: bool = False, header: bool = False, distinct: bool = False) -> None:
    """Tab-separated, gzip. sort: rows are cut into ranges in natural order, so the files in the order of their names, put one after the other, are one sorted file.

    distinct: each row once; the ranges hold equal rows together, so sorted rows are dealt out once."""
    if sort and distinct:
        keys = natural_keys(df.columns)
        out = df.withColumns(keys).repartitionByRange(*keys).select(*keys).distinct().sortWithinPartitions(*keys).select(*df.columns)
    else:
        out = df.distinct() if distinct else df
        out = out.orderBy(*natural_order(df.columns)) if sort else out
    out.write.mode("overwrite").csv(path, sep="\t", compression="gzip", header=header)


def order_breaks(df: DataFrame) -> int:
    """How many neighbours of stored text rows are out of natural order, inside files and from file to file. df: as spark.read gives it."""
    keys = natural_order(df.columns)
    rows = df.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    inside = rows.withColumn("before", F.lag("k").over(Window.partitionBy("file").orderBy("line")))
    files = inside.groupBy("file").agg(F.min_by("k", "line").alias("first"), F.max_by("k", "line").alias("last"), F.count_if(F.col("before") > F.col("k")).alias("n"))
    files = files.withColumn("before", F.lag("last").over(Window.orderBy("file")))  # one row for each file
    return files.agg(F.coalesce(F.sum(F.col("n") + F.when(F.col("before") > F.col("first"), 1).otherwise(0)), F.lit(0))).first()[0]


def read_sorted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that write_text sorted; text out of order is an error."""
    df = spark.read.schema(schema).csv(path, sep="\t")
    if broken := order_breaks(df):
        raise ValueError(f"{broken} rows of {path} are out of order")
    return df


def write_joined_by_chr(df: DataFrame, path: str) -> None:
    df.repartition("Chr", F.floor(F.col("Pos") / 1_000_000)).sortWithinPartitions("Chr", "Pos").write.mode("overwrite").partitionBy("Chr").parquet(path)
