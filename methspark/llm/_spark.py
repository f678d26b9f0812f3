"""Shared folder for checkpoints, places of rows, and components of links."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._text import U, mix, thrifty


#: Files whose ranks are broadcast.
MAX_FILES = 50_000
SIEVE_BITS = 27


def shared(spark: SparkSession) -> None:
    """Makes sure that checkpoint() has a folder: the session's spark.checkpoint.dir, else (local mode only) a new one."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if folder is None and master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def free(columns: list[str], *names: str) -> tuple[str, ...]:
    """The names, lengthened until they clash with no column (nor with each other) in any case."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return tuple(out)


def placed(docs: DataFrame, name: str) -> DataFrame:
    """docs with a long column of unique places that every reading gives alike, also if executors come and go.

    Rows of stored Parquet files have their file's rank and their number in it; anything else is checkpointed."""
    shared(docs.sparkSession)
    plan, nodes = docs._jdf.queryExecution().analyzed(), []
    while True:
        nodes.append(plan.nodeName())
        if plan.children().size() != 1:
            break
        plan = plan.children().apply(0)
    scan = nodes[-1] == "LogicalRelation" and set(nodes[:-1]) <= {"Project", "Filter", "SubqueryAlias"} and "parquet" in plan.toString().lower() and docs._jdf.queryExecution().analyzed().deterministic()
    path, number, rank = free([*docs.columns, name], "path", "number", "rank")
    if scan and "_metadata" not in docs.columns:
        files = docs.select(F.col("_metadata.file_path").alias(path)).distinct()
        some = [r[0] for r in files.limit(MAX_FILES + 1).collect()]
        if len(some) <= MAX_FILES:
            ranks = F.broadcast(docs.sparkSession.createDataFrame([(f, k) for k, f in enumerate(sorted(some))], f"`{path}` string, `{rank}` long"))
        else:  # the same ranks as a table, which has one row for each file
            ranks = files.withColumn(rank, F.row_number().over(Window.orderBy(path)).cast("long") - 1).checkpoint()
        own = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(number)).join(ranks, path)
        return own.select(*[F.col(f"`{c}`") for c in docs.columns], (F.shiftleft(rank, 40) + F.col(number)).alias(name))
    return docs.withColumn(name, F.monotonically_increasing_id()).checkpoint()


class Sieve:
    """A broadcast table of bits that tells most values that are not among the keys; it lets all pass beyond 16 million keys.

    keys: one stored long column, distinct."""

    def __init__(self, keys: DataFrame):
        self.log, self.table = max(16, (8 * keys.count()).bit_length()), None
        if self.log > SIEVE_BITS:
            return
        log, bits = self.log, np.zeros(1 << (self.log - 3), np.uint8)

        def place(batches):
            for batch in batches:
                at = mix(np.array(batch.column(0)).astype(U)) >> U(64 - log)
                yield pa.RecordBatch.from_arrays([pa.array((at >> U(16)).astype(np.int64)), pa.array((at & U(65535)).astype(np.int64))], ["chunk", "place"])

        def packed(rows: pa.Table) -> pa.Table:
            flags = np.zeros(1 << 16, bool)
            flags[rows["place"].to_numpy()] = True
            return pa.table({"chunk": rows["chunk"].slice(0, 1), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

        for r in keys.mapInArrow(thrifty(place), "chunk long, place long").groupBy("chunk").applyInArrow(thrifty(packed), "chunk long, bits binary").toLocalIterator():
            bits[r["chunk"] << 13 : (r["chunk"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
        self.table = keys.sparkSession.sparkContext.broadcast(bits)

    def passes(self, values: np.ndarray) -> np.ndarray:
        """Which values may be keys."""
        if self.table is None:
            return np.ones(len(values), bool)
        at = mix(values.astype(U)) >> U(64 - self.log)
        return (self.table.value[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1


def within(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """df without most rows whose long column is not among the keys (one stored column, distinct), before a join on it."""
    sieve = Sieve(keys)
    if sieve.table is None:
        return df

    def look(batches):
        for batch in batches:
            yield batch.filter(pa.array(sieve.passes(np.array(batch.column(column)))))

    return df.mapInArrow(thrifty(look), df.schema)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node reaches over the links (a, b).

    Labels fall along links and then by pointer jumping until none changes; every round is cut by a
    checkpoint, and both sides of its joins are stored tables, so a hot node's rows can be split."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root")).checkpoint()
    while True:
        near = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "root")
        low = near.unionAll(labels.select("node", "root")).groupBy("node").agg(F.min("root").alias("root")).checkpoint()
        up = low.select(F.col("node").alias("at"), F.col("root").alias("next"))
        new = low.join(up, low["root"] == up["at"], "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root")).checkpoint()
        old = labels.select("node", F.col("root").alias("old"))
        if new.join(old, "node").where("root <> old").isEmpty():
            break
        labels = new
    return nodes.select("node").join(new, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
