"""End-to-end jobs on the smallest tables with small settings."""

from pyspark.sql import functions as F

from screensift.operators.search_loop import SearchOptions
from screensift.plans import features as fx
from screensift.plans import jobs
from screensift.session import scratch_path
from screensift.sources import tables as tb

from .conftest import SMOKE


def test_find_model_then_classify(spark):
    lab = tb.labelled_records(spark, SMOKE)
    unl = tb.unlabelled_records(spark, SMOKE)
    out = scratch_path(spark, "p1")
    from screensift.operators import search as H

    user = spark.createDataFrame([("xgboost", "booster", "singular", None, None, None, "gblinear", None),
                                  ("xgboost", "n_estimators", "int", 5.0, 10.0, False, None, None)],
                                 H.RANGE_SCHEMA)
    opts = jobs.FindModelOptions(
        model_name="xgboost",
        search=SearchOptions(study="t", model_name="xgboost", n_trials=2, nfolds=3, batch_size=2),
        stability_repeats=1, learning_curve_folds=3, learning_curve_proportions=(0.5, 1.0), user_ranges=user)
    paths = jobs.find_model(spark, lab, unl, out, opts)
    assert spark.read.parquet(paths["tfidf"]).count() > 0
    assert spark.read.parquet(f"{out}/reports/roc").count() > 0
    assert spark.read.parquet(f"{out}/search/trials").count() == 2
    pred = jobs.classify(spark, unl, paths["model"], 0.0, scratch_path(spark, "p3"))
    assert pred.count() == unl.count()
    assert set(r["pred"] for r in pred.select("pred").distinct().collect()) <= {0, 1}


def test_analyse_threshold_and_compare(spark):
    f = fx.prepare(spark, SMOKE)
    params = {"booster": "gblinear", "n_estimators": 10}
    rep = jobs.analyse_threshold(spark, f.labelled, f.labels, "xgboost", params, 0.0, nfolds=3, repeats=2)
    assert rep["metrics"].count() == 6
    conf = rep["confusion"].collect()
    assert {r["split"] for r in conf} == {"train", "valid"}
    cmp = jobs.compare_models(spark, f.labelled, f.labels,
                              [("lin", "xgboost", params, 0.0), ("svc", "SVC", {"C": 1.0}, 0.0)])
    assert cmp.select("model").distinct().count() == 2
    assert cmp.filter(F.col("auc").isNull()).count() == 0


def test_search_resumes(spark):
    from screensift.operators import search as H
    from screensift.operators.search_loop import load_study, run_search

    f = fx.prepare(spark, SMOKE)
    rng = H.merge_ranges(H.default_ranges(spark), spark.createDataFrame(
        [("xgboost", "booster", "singular", None, None, None, "gblinear", None),
         ("xgboost", "n_estimators", "int", 5.0, 8.0, False, None, None)], H.RANGE_SCHEMA))
    path = scratch_path(spark, "search-resume")
    opts = SearchOptions(study="r", model_name="xgboost", n_trials=1, nfolds=3, batch_size=1)
    run_search(spark, f.labelled, f.labels, rng, opts, path)
    opts2 = SearchOptions(study="r", model_name="xgboost", n_trials=2, nfolds=3, batch_size=1)
    run_search(spark, f.labelled, f.labels, rng, opts2, path)
    t, s = load_study(spark, path, "r")
    assert sorted(r["trial"] for r in t.collect()) == [0, 1]
