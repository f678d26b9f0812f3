"""Accuracy of calls against truth, read by read and site by site.

Read-level metrics work on rows (by..., y_true 0/1, y_pred 0/1, y_score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import pearson_pvalue
from ..functions.scalar import safe_corr
from ..storage import stored
from .joins import SITE


def ratio(a, b) -> Column:
    """a / b, or 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def call_counts(rows: DataFrame, by=("tool",)) -> DataFrame:
    """Calls with truth (SITE, by..., y_true, y_pred) as one row for each site: up and down, its calls predicted 1 and 0.

    Regions are joined to these rows, not to the calls."""
    hit = lambda p: F.count_if(F.col("y_pred") == p)
    return rows.groupBy(*SITE, *by, "y_true").agg(hit(1).alias("up"), hit(0).alias("down"))


def read_level_metrics(counts: DataFrame, by=("tool", "tag")) -> DataFrame:
    """Both classes' precision, recall and F1, their means, accuracy, and the numbers of sites and of calls by true class. counts: call_counts with by."""
    of = lambda c, y: F.sum(F.when(F.col("y_true") == y, F.col(c)).otherwise(0))
    out = counts.groupBy(*by).agg(of("up", 1).alias("tp"), of("up", 0).alias("fp"), of("down", 1).alias("fn"), of("down", 0).alias("tn"), F.count_if(F.col("y_true") == 0).alias("sites_5c"), F.count_if(F.col("y_true") == 1).alias("sites_5mc"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = out.withColumns({"sites": F.col("sites_5c") + F.col("sites_5mc"), "calls_5c": fp + tn, "calls_5mc": tp + fn, "calls": tp + fp + fn + tn})
    out = out.withColumns({"accuracy": ratio(tp + tn, F.col("calls")), "p_5mc": ratio(tp, tp + fp), "r_5mc": ratio(tp, tp + fn), "p_5c": ratio(tn, tn + fn), "r_5c": ratio(tn, tn + fp)})
    out = out.withColumns({"f1_5mc": ratio(2 * F.col("p_5mc") * F.col("r_5mc"), F.col("p_5mc") + F.col("r_5mc")), "f1_5c": ratio(2 * F.col("p_5c") * F.col("r_5c"), F.col("p_5c") + F.col("r_5c"))})
    return out.withColumns({"macro_p": (F.col("p_5mc") + F.col("p_5c")) / 2, "macro_r": (F.col("r_5mc") + F.col("r_5c")) / 2, "macro_f1": (F.col("f1_5mc") + F.col("f1_5c")) / 2, "micro_f1": F.col("accuracy")})


def read_level_metrics_binary(counts: DataFrame, by=("tool",)) -> DataFrame:
    """Accuracy, precision, recall and F1 of the methylated class, numbers of sites and of predictions, in all and by class."""
    names = {"accuracy": "accuracy", "p_5mc": "precision", "r_5mc": "recall", "f1_5mc": "f1", "sites": "bases", "calls": "preds", "calls_5c": "preds_5c", "calls_5mc": "preds_5mc"}
    return read_level_metrics(counts, by).select(*by, *[F.col(a).alias(b) for a, b in names.items()])


def confusion_matrix(rows: DataFrame, by=("tool",)) -> DataFrame:
    return rows.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


RANGES = [k / 64 for k in range(1, 64)]


def running_totals(t: DataFrame, by: list[str], order: Column, totals: dict[str, Column], down: bool = False) -> DataFrame:
    """t with the sums of columns over all rows of the group up to each row in the order.

    t is computed once and stored. Its rows are cut into
    ranges by approximate quantiles; sums run inside each and start from the ranges before, of which there is one row
    each, so no task holds a group. Rows of one order share their sums."""
    t = stored(t.withColumn("_at", -order if down else order))
    cuts = t.groupBy(*by).agg(F.percentile_approx("_at", RANGES).alias("_cuts"))
    rows = t.join(cuts, by).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col("_at")))).drop("_cuts")
    sums = rows.groupBy(*by, "_range").agg(*[F.sum(x).alias(f"_{c}") for c, x in totals.items()])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select(*by, "_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in totals])
    inside = Window.partitionBy(*by, "_range").orderBy("_at")
    out = rows.join(start, [*by, "_range"])
    return out.withColumns({c: F.sum(x).over(inside) + F.col(f"_{c}") for c, x in totals.items()}).drop("_at", "_range", *[f"_{c}" for c in totals])


def thresholds(rows: DataFrame, by: list[str], n: Column | None = None) -> DataFrame:
    """Positives and negatives at and above each distinct score; n: how many calls a row stands for."""
    count = lambda y: F.sum(F.when(F.col("y_true") == y, F.lit(1) if n is None else n).otherwise(0))
    t = rows.groupBy(*by, "y_score").agg(count(1).alias("pos"), count(0).alias("neg"))
    return running_totals(t, by, F.col("y_score"), {"tp": F.col("pos"), "fp": F.col("neg")}, down=True)


def areas() -> dict[str, Column]:
    """Aggregates of thresholds: the area under the ROC curve, ties counting half (null with one class), and average precision."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return {"roc_auc": F.try_divide(area, (F.sum("pos") * F.sum("neg")).cast("double")), "average_precision": F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.sum("pos").cast("double"))}


def weighted_metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """All metrics of counted calls (by..., y_true, y_pred, y_score, n), the prediction being one of the score's sign."""
    t = thresholds(rows.where("n > 0"), by, F.col("n"))
    part = lambda c, sign: F.sum(F.when(sign, F.col(c)).otherwise(0))
    up = F.col("y_score") > 0
    out = t.groupBy(*by).agg(part("pos", up).alias("tp"), part("neg", up).alias("fp"), part("pos", ~up).alias("fn"), part("neg", ~up).alias("tn"), *[v.alias(k) for k, v in areas().items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = out.withColumns({"preds": tp + fp + fn + tn, "preds_5c": fp + tn, "preds_5mc": tp + fn, "accuracy": ratio(tp + tn, tp + fp + fn + tn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.select(*by, f1.alias("f1"), "roc_auc", "average_precision", "accuracy", "precision", "recall", "preds", "preds_5c", "preds_5mc")


def roc_auc(rows: DataFrame, by=("tool",), n: Column | None = None) -> DataFrame:
    """Area under the ROC curve, ties counting half; null with one class. n: how many calls a row stands for."""
    return thresholds(rows, list(by), n).groupBy(*by).agg(areas()["roc_auc"].alias("roc_auc"))


def average_precision(rows: DataFrame, by=("tool",), n: Column | None = None) -> DataFrame:
    return thresholds(rows, list(by), n).groupBy(*by).agg(areas()["average_precision"].alias("average_precision"))


def curve_points(rows: DataFrame, by=("tool",), n: Column | None = None) -> DataFrame:
    """fpr, tpr (= recall) and precision at each distinct score."""
    t = thresholds(rows, list(by), n)
    total = t.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    out = t.join(total, list(by))
    return out.select(*by, "y_score", ratio(F.col("fp"), F.col("_n")).alias("fpr"), ratio(F.col("tp"), F.col("_p")).alias("tpr"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def site_correlation(matrix_long: DataFrame, by=("tool",)) -> DataFrame:
    """Pearson's r, its two-sided p, mean squared error and n of pairs (freq, bs_freq)."""
    x, y = F.col("freq"), F.col("bs_freq")
    own = matrix_long.where(x.isNotNull() & y.isNotNull())
    out = own.groupBy(*by).agg(safe_corr(x, y).alias("r"), F.avg((x - y) * (x - y)).alias("mse"), F.count("*").alias("n"))
    return out.withColumn("p", pearson_pvalue(F.col("r"), F.col("n")))


def correlation_matrix(matrix: DataFrame, cols: list[str]) -> DataFrame:
    """r of every pair of columns over rows where both are there, in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    one = matrix.agg(*[F.struct(safe_corr(F.col(a), F.col(b)).alias("r"), F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("n")).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{k}.r").alias("r"), F.col(f"p{k}.n").alias("n")) for k, (a, b) in enumerate(pairs)])).alias("x")
    return one.select(rows).select("x.*")


def accuracy_by_freq_bin(pairs: DataFrame, bins: int = 10) -> DataFrame:
    """Errors by right-closed bin of the truth (the first holds 0 too); bin 0 is all."""
    x, y = F.col("freq"), F.col("bs_freq")
    own = F.greatest(F.lit(1), F.ceil(y * bins - 1e-9)).cast("int")
    both = pairs.select(x, y, F.explode(F.array(F.lit(0), own)).alias("bin"))
    d = x - y
    out = both.groupBy("bin").agg(F.count("*").alias("n"), F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"), safe_corr(x, y).alias("r"), F.var_pop(y).alias("_v"))
    return out.select("bin", "n", "mae", "mse", F.sqrt("mse").alias("rmse"), "r", F.when(F.col("_v") > 1e-12, 1 - F.try_divide("mse", "_v")).alias("r2"))


def tools_ranked_by_corr(correlations: DataFrame) -> DataFrame:
    return correlations.select("tool", "r", F.rank().over(Window.orderBy(F.desc("r"))).alias("rank"))
