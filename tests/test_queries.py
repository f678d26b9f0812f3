"""Every registered query of the methylation operators against its SQL."""

import os

import duckdb
import pandas as pd
import pytest

from methspark.registry import ENTRY, ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    text = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:.8g}" if isinstance(v, float) else str(v)
    return list(df.columns), sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sql, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(sql.sql(ORACLE[name]).df())


def test_entry_is_registered():
    assert ENTRY in QUERIES


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_folds_are_stratified(spark):
    """Within each label fold sizes differ by one at most, whatever the ranges; a seed gives the same folds again."""
    from methspark.models.consensus import folds

    df = spark.range(1000).selectExpr("cast(id as string) as ID", "'chr1' as Chr", "id as Pos", "'+' as Strand", "cast(id % 7 = 0 as double) as label")
    for cv, ranges in ((3, 256), (7, 2), (5, 1)):
        rows = folds(df, cv, 42, ranges).collect()
        sizes = pd.DataFrame([r.asDict() for r in rows]).groupby(["label", "fold"]).size()
        assert len(rows) == 1000 and len(sizes) == 2 * cv and all(sizes[y].max() - sizes[y].min() <= 1 for y in (0.0, 1.0))
    again = lambda df: sorted((r.ID, r.fold) for r in folds(df, 3, 42).collect())
    assert again(df) == again(df.repartition(5)) != sorted((r.ID, r.fold) for r in folds(df, 3, 1).collect())


def test_consensus_beats_every_caller(spark):
    """On chromosomes it was not trained on, over the calls that a caller makes, the chosen model's F1 is above that caller's; all metrics against a plain recount."""
    from methspark.plans import more

    rows = {(r.test, r.tool, r.tag): r for r in QUERIES["eval_models_by_region"](spark, SF).collect()}
    scored = more.test_rows(spark, SF).select("label", "test", *more.TOOLS, "boosted").toPandas()
    for test in ("one", "two", "pooled"):
        own = scored if test == "pooled" else scored[scored.test == test]
        for t in [*more.TOOLS, "boosted"]:
            x, r = own[own[t].notna()], rows[test, t, "Genome-wide"]
            y, p = x.label == 1, x[t] > 0
            assert (r.preds, r.preds_5mc) == (len(x), y.sum()) and abs(r.accuracy - (y == p).mean()) < 1e-9
            assert abs(r.f1 - 2 * (y & p).sum() / (y.sum() + p.sum())) < 1e-9
            pos, neg = x[t][y].to_numpy(), x[t][~y].to_numpy()
            higher = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
            assert abs(r.roc_auc - higher) < 1e-9
    f1 = lambda y, p: 2 * (y & p).sum() / (y.sum() + p.sum())
    for t in more.TOOLS:
        own = scored[scored[t].notna()]
        assert f1(own.label == 1, own.boosted > 0) > f1(own.label == 1, own[t] > 0)
    table = QUERIES["train_consensus_gbt"](spark, SF).collect()
    assert len(table) == 3 and all(0.5 < r.mean_score < 1 for r in table)


def test_predictions_are_the_models(spark):
    """Predict: probability and class agree, each row once, missing tools too; no row, no prediction."""
    from methspark.plans import more

    got = QUERIES["predict_consensus"](spark, SF).toPandas()
    want = more.training(spark, SF).where("Chr in ('chr1', 'chr3')").count()
    assert len(got) == want and ((got.Prob_methylation > 0.5) == (got.Prediction == 1)).all() and got[more.TOOLS].isna().any().all()
    scaled = QUERIES["predict_rf_scaled"](spark, SF).toPandas()
    whole = more.training(spark, SF).where("Chr in ('chr1', 'chr3')").dropna(subset=more.TOOLS).toPandas()
    both = whole.merge(scaled, on=["ID", "Chr", "Pos", "Strand"])
    assert len(scaled) == len(whole) and (both.label == both.Prediction).mean() > 0.85
    sites = {(r.tool, r.tag): r for r in QUERIES["consensus_site_eval"](spark, SF).collect()}
    means = pd.concat([t.toPandas() for t in more.site_tables(spark, SF)])
    for t in [*more.TOOLS, "boosted"]:
        own = means[means[t].notna()]
        assert abs(sites[t, "Genome-wide"].r - own[t].corr(own.bs_freq)) < 1e-9 and sites[t, "Genome-wide"].n == len(own)


def test_natural_order(spark):
    from methspark.operators.joins import sort_sites_natural

    names = ["chrUn_KI270302v1", "chr10", "chrM", "chr2", "chr22_KI270731v1_random", "chrX", "chr22", "chrY", "1"]
    rows = sort_sites_natural(spark.createDataFrame([(n, p, "+") for n in names for p in (20, 3)], "Chr string, Pos long, Strand string")).collect()
    want = ["1", "chr2", "chr10", "chr22", "chrX", "chrY", "chrM", "chr22_KI270731v1_random", "chrUn_KI270302v1"]
    assert [(r.Chr, r.Pos) for r in rows] == [(n, p) for n in want for p in (3, 20)]


def test_pvalues(spark):
    from pyspark.sql import functions as F

    from methspark.functions.distributions import pearson_pvalue

    df = spark.createDataFrame([(0.5, 10), (0.9, 5), (0.0, 8), (-0.3, 100), (0.7, 2), (None, 9)], "r double, n long")
    got = [r[0] for r in df.select(pearson_pvalue(F.col("r"), F.col("n"))).collect()]
    assert [round(x, 4) for x in got[:4]] == [0.1411, 0.0374, 1.0, 0.0024] and got[4:] == [None, None]
