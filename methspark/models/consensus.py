"""Consensus of several callers by Spark ML: training, search of parameters, prediction and evaluation.

Training rows: ID, Chr, Pos, Strand, one score column for each tool, label (0/1) and, if used, k_mer and weight.
A missing score is filled with 0 and marked by an indicator column, so every outer-joined row is predicted."""

from __future__ import annotations

import itertools
import random
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import prob_to_llr2
from ..operators.genome import BASES, KMER, kmer_bits, kmer_text
from ..operators.joins import SITE
from ..operators.metrics import site_correlation, weighted_metrics
from ..storage import stored

#: The k-mer's places and bases as one vector; of columns there would be so many that no task's code is compiled.
BITS = "kmer_bits"
GBT_GRID = {"maxDepth": [3, 5], "stepSize": [0.1, 0.3], "maxIter": [5, 10]}
RF_GRID = {"maxDepth": [4, 8], "numTrees": [10, 20]}


def features(df: DataFrame, tools: list[str], kmer: bool = False) -> tuple[DataFrame, list[str]]:
    """The rows with feature columns, and their names."""
    out = df.withColumns({f"{t}_missing": F.col(t).isNull().cast("double") for t in tools}).na.fill(0.0, tools)
    names = [*tools, *[f"{t}_missing" for t in tools]]
    if kmer:
        bits = array_to_vector(kmer_bits(kmer_text(F.col("k_mer"))))
        out, names = out.withColumn(BITS, bits), [*names, BITS]
    return out, names


def folds(df: DataFrame, cv: int, seed: int, ranges: int = 256) -> DataFrame:
    """A fold number for each row; within each label the folds' sizes differ by one at most.

    Rows of a label are ranked in a seeded order by hash and dealt in turn. Ranks are counted inside ranges of the
    hash and start from the ranges before, of which there is one row each, so no task holds a label."""
    h = F.xxhash64(F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("ID", *SITE)])
    rows = df.withColumn("_h", h).withColumn("_range", F.pmod(F.shiftrightunsigned("_h", 32), F.lit(ranges)))
    counts = rows.groupBy("label", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(F.col("label").alias("_label"), F.col("_range").alias("_own"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("label", "_range").orderBy("_h", "ID", *SITE))
    out = rows.withColumn("_in", inside).join(F.broadcast(start), F.col("label").eqNullSafe(F.col("_label")) & (F.col("_range") == F.col("_own")))
    return out.withColumn("fold", F.pmod(F.col("_start") + F.col("_in") - 1, F.lit(cv)).cast("int")).select(*df.columns, "fold")


def sampled_grid(estimator, grid: dict[str, list], niter: int, seed: int) -> list[dict]:
    """At most niter different points of the grid, drawn with a seed."""
    points = [dict(zip(grid, x, strict=True)) for x in itertools.product(*grid.values())]
    random.Random(seed).shuffle(points)
    return [{getattr(estimator, k): v for k, v in p.items()} for p in points[:niter]]


def _search(estimator, grid: dict[str, list], train: DataFrame, names: list[str], weighted: bool, niter: int, cv: int, scoring: str, seed: int) -> tuple[PipelineModel, DataFrame]:
    estimator.setFeaturesCol("features").setLabelCol("label").setSeed(seed)
    if weighted:
        estimator.setWeightCol("weight")
    points = sampled_grid(estimator, grid, niter, seed)
    sizes = [VectorSizeHint(inputCol=BITS, size=KMER * len(BASES), handleInvalid="optimistic")] if BITS in names else []
    vector = [*sizes, VectorAssembler(inputCols=names, outputCol="features")]
    search = CrossValidator(estimator=estimator, estimatorParamMaps=points, evaluator=MulticlassClassificationEvaluator(metricName=scoring), numFolds=cv, foldCol="fold", seed=seed)
    rows = folds(train.withColumn("label", F.col("label").cast("double")), cv, seed)
    # a fit runs hundreds of jobs over these rows; with the plan that made them, each would carry that plan along
    rows = stored(PipelineModel(vector).transform(rows).select("features", "label", "fold", *(["weight"] if weighted else [])))
    found = search.fit(rows)
    table = [(k, ",".join(f"{p.name}={v}" for p, v in sorted(x.items(), key=lambda y: y[0].name)), float(s)) for k, (x, s) in enumerate(zip(points, found.avgMetrics, strict=True))]
    return PipelineModel([*vector, found.bestModel]), train.sparkSession.createDataFrame(table, "candidate int, params string, mean_score double")


def train_consensus_gbt(train: DataFrame, tools: list[str], kmer: bool = False, weighted: bool = False, niter: int = 2, cv: int = 3, scoring: str = "f1", seed: int = 42, grid: dict[str, list] | None = None) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on the tools' scores, the best of a random search by stratified folds, and the search's table (#155)."""
    rows, names = features(train, tools, kmer)
    return _search(GBTClassifier(), grid or GBT_GRID, rows, names, weighted, niter, cv, scoring, seed)


def train_consensus_rf(train: DataFrame, tools: list[str], niter: int = 2, cv: int = 3, scoring: str = "f1", seed: int = 42, grid: dict[str, list] | None = None) -> tuple[PipelineModel, DataFrame]:
    """A random forest on scores with missing ones as a constant."""
    rows, _ = features(train, tools)
    return _search(RandomForestClassifier(), grid or RF_GRID, rows, list(tools), False, niter, cv, scoring, seed)


def predict_consensus(model: PipelineModel, wide: DataFrame, tools: list[str], kmer: bool = False) -> DataFrame:
    """READ, the scores given, Prediction and Prob_methylation of every row; no row gives no row."""
    rows, _ = features(wide.withColumns({f"{t}_given": F.col(t) for t in tools}), tools, kmer)
    out = model.transform(rows).withColumn("p", vector_to_array("probability"))
    return out.select("ID", *SITE, *[F.col(f"{t}_given").alias(t) for t in tools], F.col("prediction").cast("int").alias("Prediction"), F.col("p")[1].alias("Prob_methylation"))


def predict_rf_scaled(train: DataFrame, wide: DataFrame, tools: list[str], seed: int = 42) -> DataFrame:
    """Rows with every tool, scores scaled to 0 to 1, predicted by a forest trained on rows scaled alike."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=tools, outputCol="raw"), MinMaxScaler(inputCol="raw", outputCol="features"), RandomForestClassifier(numTrees=10, maxDepth=5, seed=seed)])
    rows = train.dropna(subset=tools).select(*tools, F.col("label").cast("double").alias("label")).persist()  # the scaler and the forest read them several times
    try:
        model = pipe.fit(rows)
    finally:
        rows.unpersist()
    out = model.transform(wide.dropna(subset=tools)).withColumn("p", vector_to_array("probability"))
    return out.select("ID", *SITE, F.col("prediction").cast("int").alias("Prediction"), F.col("p")[1].alias("Prob_methylation"))


def with_models(wide: DataFrame, models: dict[str, PipelineModel], tools: list[str], kmer: bool = False) -> DataFrame:
    """The rows with one score column (log2 ratio) more for each model."""
    out = wide
    for name, model in models.items():
        rows, _ = features(out.withColumns({f"{t}_given": F.col(t) for t in tools}), tools, kmer)
        own = model.transform(rows).withColumn("p", vector_to_array("probability")).withColumn(name, prob_to_llr2(F.col("p")[1]))
        out = own.select(*[F.col(f"{c}_given").alias(c) if c in tools else c for c in out.columns], name)
    return out


def long_scores(scored: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each tool or model that scored a row: the row's other columns, tool, score."""
    rest = [c for c in scored.columns if c not in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("tool"), F.col(c).alias("score")) for c in columns])
    return scored.select(*rest, F.explode(pairs).alias("x")).select(*rest, "x.*").where("score is not null")


def eval_models_by_region(scored: DataFrame, columns: list[str], tags: DataFrame, tests: str = "test") -> DataFrame:
    """Tools and models by test set and region, each test set alone and all of them pooled (test set `pooled`).

    scored: READ, label (truth), the test set's column and score columns; tags: SITE, tag. Calls are counted by
    score before regions and test sets are told apart, so pooling and every region share one count; from it come F1,
    ROC_AUC, average precision, accuracy, precision, recall and the numbers of predictions by class."""
    counts = long_scores(scored.select(*SITE, "label", tests, *columns), columns).groupBy(*SITE, "tool", "score", F.col("label").cast("int").alias("y_true"), F.col(tests).alias("test")).agg(F.count("*").alias("n"))
    rows = counts.join(tags, SITE).groupBy("tool", "tag", "test", "y_true", F.col("score").alias("y_score")).agg(F.sum("n").alias("n"))
    pooled = rows.withColumn("test", F.explode(F.array("test", F.lit("pooled"))))
    return weighted_metrics(pooled.withColumn("y_pred", (F.col("y_score") > 0).cast("int")), ["test", "tool", "tag"])


def consensus_site_eval(scored: DataFrame, columns: list[str], truth: DataFrame, min_reads: int = 3) -> DataFrame:
    """Pearson's r with p and mean squared error with truth of the site means of score >= 0. truth: SITE, bs_freq."""
    return agg_site_tables([site_means(scored, columns, truth, min_reads)], columns)


def site_means(scored: DataFrame, columns: list[str], truth: DataFrame, min_reads: int = 3) -> DataFrame:
    """SITE, bs_freq, reads and for each tool or model the share of its reads with score >= 0; the table that is stored and aggregated again."""
    means = scored.groupBy(*SITE).agg(*[F.avg((F.col(c) >= 0).cast("int")).alias(c) for c in columns], F.count("*").alias("reads")).where(F.col("reads") >= min_reads)
    return means.join(truth, SITE)


def agg_site_tables(tables: list[DataFrame], columns: list[str], tags: DataFrame | None = None) -> DataFrame:
    """Stored site tables under each other: r, p, error and n by tool, and by region if tags (SITE, tag) are given."""
    rows = reduce(DataFrame.unionByName, tables)
    if tags is not None:
        rows = rows.join(tags, SITE)
    by = ["tool"] if tags is None else ["tool", "tag"]
    return site_correlation(long_scores(rows.select(*(["tag"] if tags is not None else []), "bs_freq", *columns), columns).withColumnRenamed("score", "freq"), by)


def stratified_split_by_chr(df: DataFrame, train: list[str], test: list[str]) -> DataFrame:
    """Rows of the named chromosomes with the part they belong to."""
    part = F.when(F.col("Chr").isin(train), "train").when(F.col("Chr").isin(test), "test")
    return df.withColumn("part", part).where("part is not null")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
