"""Proportional stratified interleaving of documents into shards.

Rows of each source are put in a seeded random order; a row's fractional rank is its place in that
order over the source's size. Rows sorted by fractional rank are cut into equal runs, so every shard
holds each source in the mixture's proportion and shard sizes differ by one row at most.

No window ever spans a whole source or table: the random order and the fractional rank are both
uniform, so they are cut into buckets whose counts, added up, give each bucket its offset.

Defined results: a null source is a stratum of its own; null or empty texts have size 1; repeated
rows each get a slot; fewer rows than shards leave shards empty; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._text import table

SHARDS = 8
ROWS_PER_BUCKET = 4096
SEED = 17


def _ranked(df: DataFrame, by: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Adds a 0-based rank by bucket and order within `by`, and the size of `by`; buckets are numbered in the same order.

    The counts by bucket have a row for each ROWS_PER_BUCKET rows and stratum or so."""
    counts = df.groupBy(*by, bucket).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), F.sum("_n").over(Window.partitionBy(*by)).alias("size"))
    inside = F.row_number().over(Window.partitionBy(*by, bucket).orderBy(*order))
    a, b = df.withColumn("_inside", inside).alias("a"), offsets.alias("b")
    match = F.lit(True)
    for c in [*by, bucket]:
        match = match & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, match).select("a.*", (F.col("_offset") + F.col("_inside") - 1).alias(out), "b.size").drop("_inside")


def interleave(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", source_col: str = "source", payload: dict | None = None, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """id, source, the payload columns, shard and slot (0-based in the shard, by fractional rank)."""
    payload = payload or {}
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("stratum"), *[v.alias(f"p_{k}") for k, v in payload.items()])
    total = docs.count()
    buckets = 1 + total // rows_per_bucket
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "id"))
    rows = rows.withColumn("b", F.floor((F.shiftrightunsigned("h", 11)) * (buckets / 2.0**53)))
    ties = [*[f"p_{k}" for k in payload]]
    ranked = _ranked(rows, ["stratum"], "b", ["h", "id", *ties], "rank")
    ranked = ranked.withColumn("frac", (2 * F.col("rank") + 1) / (2 * F.col("size"))).withColumn("one", F.lit(0))
    ranked = ranked.withColumn("b", F.floor(F.col("frac") * buckets)).drop("size")
    placed = _ranked(ranked, ["one"], "b", ["frac", "stratum", "h", "id", *ties], "at")
    # shard k starts at ceil(k * total / shards)
    shard = F.expr(f"(at * {shards}) div {max(total, 1)}")
    start = F.expr(f"((at * {shards}) div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    return placed.select(F.col("id").alias(id_col), F.col("stratum").alias(source_col), *[F.col(f"p_{k}").alias(k) for k in payload], shard.cast("int").alias("shard"), (F.col("at") - start).cast("long").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    payload = {"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary"))}
    out = interleave(table(spark, sf_dir, "documents"), payload=payload)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
