"""Incremental forms of two batch results: unified calls, and counts by site.

Both keep what they must know of earlier files in the stream's state store (on disk, with its changes logged
in the checkpoint), so a batch costs what its own rows cost, however many came before. A store and its
checkpoint belong together; a batch that is run again after a failure leaves the store as it was."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.joins import SITE

CALLS = "tool string, ID string, Chr string, Pos bigint, Strand string, Score double"
COUNTS = "tool string, Chr string, Pos bigint, Strand string, cov bigint, meth bigint"
#: Batches after which the changes of site counts are merged into one table.
MERGE_EVERY = 8
#: Groups that the reads of a stream are dealt into.
READ_GROUPS = 4096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_IN_MEMORY, _ON_DISK = (f"org.apache.spark.sql.execution.streaming.state.{n}" for n in ("HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state on disk, unless the session names a store of its own."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ON_DISK if before.endswith(_IN_MEMORY.rsplit(".", 1)[-1]) else before)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _source(spark: SparkSession, in_dir: str, schema: str, files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(in_dir)


def _unseen() -> StatefulProcessor:
    """The calls of a group's reads at places where the read had none yet, the lowest score of each.

    The state has one row for each read, its places. A function called for each read spends nearly all its time
    on the call itself; a group of reads is one frame, and only its reads' state goes row by row. The class is made
    here so that it is sent as it is: the worker beside the driver may not find this package."""

    class Unseen(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.places = handle.getMapState("places", "tool string, ID string", "places array<string>")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            calls = pd.concat(list(rows), ignore_index=True).drop(columns="reads").sort_values("Score", na_position="last").drop_duplicates(["tool", "ID", *SITE])
            places = (calls["Chr"].astype(str) + ":" + calls["Pos"].astype(str) + calls["Strand"].astype(str)).tolist()
            own: dict[tuple, list[int]] = {}
            for row, read in enumerate(zip(calls["tool"].tolist(), calls["ID"].tolist(), strict=True)):
                own.setdefault(read, []).append(row)
            any_seen, new = self.places.exists(), []
            for read, at in own.items():
                before = self.places.getValue(read) if any_seen else None
                seen = list(before[0]) if before else []
                known = set(seen)
                if fresh := [row for row in at if places[row] not in known]:
                    self.places.updateValue(read, (seen + [places[row] for row in fresh],))
                    new += fresh
            if new:
                yield calls.iloc[new]

        def close(self) -> None:
            pass

    return Unseen()


def stream_unify_batches(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str = CALLS, files: int | None = None, groups: int = READ_GROUPS) -> StreamingQuery:
    """New call files, one call for each read and place; calls that stand in the output already are left out.

    The state has one row for each tool and read: the places it was called at. files: how many make one batch.
    groups: into how many the reads are dealt by hash; a task holds one group's calls of one batch at a time, and
    a checkpoint keeps the number it began with."""
    with _state_on_disk(spark):
        calls = _source(spark, in_dir, schema, files).select(*[f.split()[0] for f in CALLS.split(", ")])
        dealt = calls.withColumn("reads", F.pmod(F.xxhash64("tool", "ID"), F.lit(groups))).groupBy("reads")
        fresh = dealt.transformWithStateInPandas(_unseen(), CALLS, "Append", "None")
        return fresh.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_dir)


class SiteStore:
    """Totals by tool and site under one folder: a merged table with one row for each, and the changes since.

    changes/batch=N holds the new totals of the sites that batch N touched; merged/upto=N those of all sites after
    it. A folder counts once it is complete; merging again after a failure writes the same rows to the same place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self, kind: str) -> list[int]:
        """The numbers of a kind's complete folders, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
        done = [p for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def parts(self) -> list[tuple[int, str]]:
        """(batch, folder) of what the totals are made of: the latest merged table and the changes after it."""
        upto = max(self._numbers("merged"), default=-1)
        changes = [(n, f"{self.path}/changes/batch={n}") for n in self._numbers("changes") if n > upto]
        return ([(upto, f"{self.path}/merged/upto={upto}")] if upto >= 0 else []) + changes

    def totals(self) -> DataFrame:
        """One row for each tool and site: the totals of the last batch that touched it."""
        out = self.spark.createDataFrame([], f"{COUNTS}, batch bigint")
        for n, path in self.parts():
            out = out.unionByName(self.spark.read.schema(COUNTS).parquet(path).withColumn("batch", F.lit(n).cast("bigint")))
        last = F.max_by(F.struct("cov", "meth"), "batch").alias("last")
        return out.groupBy("tool", *SITE).agg(last).select("tool", *SITE, "last.*")

    def put(self, totals: DataFrame, batch: int, every: int) -> None:
        """Stores what one batch changed, and merges after each `every` batches."""
        totals.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
        if (batch + 1) % every == 0 and batch > max(self._numbers("merged"), default=-1):
            old = self._numbers("merged")
            self.totals().write.mode("overwrite").parquet(f"{self.path}/merged/upto={batch}")
            # what the table before was made of goes; the table itself stays for those who are reading it
            for n in old[:-1]:
                self._remove(f"merged/upto={n}")
            for n in self._numbers("changes"):
                if old and n <= old[-1]:
                    self._remove(f"changes/batch={n}")


def stream_site_counts(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str = CALLS, files: int | None = None, every: int = MERGE_EVERY) -> StreamingQuery:
    """Running counts by tool and site in a SiteStore; site_counts() reads them. The state has one row for each of them."""
    with _state_on_disk(spark):
        totals = _source(spark, in_dir, schema, files).groupBy("tool", *SITE).agg(F.count("*").alias("cov"), F.count_if(F.col("Score") > 1e-5).alias("meth"))
        store = SiteStore(spark, out_dir)
        return totals.writeStream.outputMode("update").foreachBatch(lambda df, batch: store.put(df, batch, every)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def site_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    return SiteStore(spark, out_dir).totals().withColumn("freq", F.col("meth") / F.col("cov"))
