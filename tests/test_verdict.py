"""Rules that earlier results broke: NULL groups and scores, dependency chains, ids of two inputs."""

import pytest
from pyspark.sql import functions as F

from screensift.functions.prefix import prefix_scan
from screensift.operators.search import chain_depth


def test_prefix_scan_keeps_null_groups_and_buckets(spark):
    rows = [("a", 1, 1.0), ("a", None, 2.0), (None, 1, 3.0), (None, None, 4.0), (None, 2, 5.0)]
    df = spark.createDataFrame(rows, "g string, b int, v double")
    out = prefix_scan(df, ["g"], "b", F.col("v"), ["v"]).collect()
    assert sorted((str(r.g), r.v, r._n) for r in out) == [("None", 3.0, 3), ("None", 4.0, 3), ("None", 5.0, 3), ("a", 1.0, 2), ("a", 2.0, 2)]


def test_dependency_chains():
    assert chain_depth([("m", chr(98 + i), chr(97 + i)) for i in range(5)]) == 5
    assert chain_depth([]) == 0
    with pytest.raises(ValueError):
        chain_depth([("m", "a", "b"), ("m", "b", "a")])


def test_ids_of_two_tsv_inputs_differ(spark):
    from screensift.session import scratch_path
    from screensift.sources import files as io

    df = spark.createDataFrame([("t", "x", "1"), ("u", "y", "0")], "title string, abstract string, included string")
    path = scratch_path(spark, "tsv-ids")
    io.write_tsv(df, path)
    a = {r.doc_id for r in io.read_labelled(spark, path).collect()}
    b = {r.doc_id for r in io.read_unlabelled(spark, path).collect()}
    assert len(a) == len(b) == 2 and not a & b


def test_trials_record_the_parameters_that_spark_uses():
    from screensift.operators.models import effective_params

    assert effective_params("lightgbm", {"max_depth": 55, "num_leaves": 4}) == {"max_depth": 30, "num_leaves": 4}
    assert effective_params("lightgbm", {"max_depth": -1})["max_depth"] == 30
    assert effective_params("RandomForestClassifier", {"max_depth": None})["max_depth"] == 30
    assert effective_params("SVC", {"max_iter": -1, "C": 2.0}) == {"max_iter": 1000, "C": 2.0}
    assert effective_params("xgboost", {"max_depth": 4}) == {"max_depth": 4}


def test_penalties_follow_the_weighted_loss():
    from screensift.operators.models import make_estimator

    booster, _ = make_estimator("xgboost", {"booster": "gblinear", "reg_lambda": 0.3, "reg_alpha": 0.1}, 500.0)
    assert booster.getRegParam() == pytest.approx(0.4) and booster.getElasticNetParam() == pytest.approx(0.25)
    svc, _ = make_estimator("SVC", {"C": 2.0}, 500.0)
    assert svc.getRegParam() == pytest.approx(0.001)


def test_whole_numbers_stay_whole_in_trial_parameters(spark):
    from screensift.operators import search as H

    active = spark.createDataFrame(
        [("s", "m", 0, "n", "int", 37.0, None), ("s", "m", 0, "x", "float", 0.5, None)],
        "study string, model string, trial int, param string, suggest_type string, value_num double, value_str string")
    fixed = spark.createDataFrame([], "model string, param string, value string")
    got = {r.param: r.value for r in H.trial_params(active, fixed, F.lit(1.0)).collect()}
    assert got == {"n": "37", "x": "0.5"}


def test_search_over_restarts_failures_and_deletion(spark):
    from pyspark.ml.linalg import Vectors

    from screensift.operators import search as H
    from screensift.operators.search_loop import SearchOptions, delete_study, load_study, run_search
    from screensift.session import scratch_path

    rows = [(i, Vectors.dense([float(i % 2), float(i)]), i % 2) for i in range(24)]
    feats = spark.createDataFrame([(r[0], r[1]) for r in rows], ["doc_id", "features"])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")

    def ranges(kernel):
        return spark.createDataFrame([("SVC", "kernel", "singular", None, None, None, kernel, None),
                                      ("SVC", "max_iter", "int", 3.0, 5.0, False, None, None)], H.RANGE_SCHEMA)

    path = scratch_path(spark, "study-delete")
    for study in ("a/b", "c"):
        trials, scores = run_search(spark, feats, labels, ranges("linear"),
                                    SearchOptions(study=study, model_name="SVC", n_trials=1), path)
    trials, scores = run_search(spark, feats, labels, ranges("linear"),
                                SearchOptions(study="a/b", model_name="SVC", n_trials=2), path)
    assert sorted(r.trial for r in trials.collect()) == [0, 1]  # the earlier run's trial is there too
    best = H.best_trial(trials.filter("state = 'COMPLETE'").select("study", "trial", "objective"), trials).first()
    assert best.params["kernel"] == "linear" and best.params["max_iter"] in ("3", "4", "5")
    delete_study(spark, path, "a/b")
    assert load_study(spark, path, "a/b")[0].count() == 0 and load_study(spark, path, "c")[0].count() == 1
    with pytest.raises(RuntimeError, match="in a row failed"):
        run_search(spark, feats, labels, ranges("sigmoid"),
                   SearchOptions(study="f", model_name="SVC", n_trials=2, max_failures_in_row=3), path)
    failed = load_study(spark, path, "f")[0].collect()
    assert {r.state for r in failed} == {"FAILED"} and all("sigmoid" in r.error for r in failed)


def test_rbf_svc_is_not_linear_and_survives_saving(spark):
    import numpy as np
    from pyspark.ml import PipelineModel
    from pyspark.ml.linalg import Vectors

    from screensift.functions.fourier import FourierMap
    from screensift.operators import models as md
    from screensift.session import scratch_path

    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 2))
    inside = (np.hypot(x[:, 0], x[:, 1]) < 1.0).astype(int)  # no line separates a disc from its surroundings
    rows = [(i, Vectors.sparse(2, [0, 1], x[i]) if i % 2 else Vectors.dense(x[i]), int(inside[i])) for i in range(80)]
    df = spark.createDataFrame(rows, ["doc_id", "features", "label"])
    right = {}
    for kernel in ("linear", "rbf"):
        model, ignored = md.fit(df, "SVC", {"kernel": kernel, "C": 100.0, "gamma": 1.0}, n_rows=80)
        scores = {r.doc_id: r.score for r in md.score(model, df).collect()}
        right[kernel] = sum((scores[i] > 0) == bool(inside[i]) for i in range(80))
        assert ignored == ()
    assert right["rbf"] >= 74 > right["linear"]
    path = scratch_path(spark, "rbf")
    model.write().save(path)
    again = {r.doc_id: r.score for r in md.score(PipelineModel.load(path), df).collect()}
    assert again == scores
    z = np.array([r.fourier.toArray() for r in FourierMap(gamma=0.5, components=4000).transform(df).select(
        "fourier").collect()])
    kernel = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.12
