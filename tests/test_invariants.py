"""Invariants of the operators on the test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screensift.operators import explain as X
from screensift.operators import metrics as M
from screensift.operators import models as md
from screensift.operators import splits as sp
from screensift.operators import tfidf as tf
from screensift.plans import features as fx
from screensift.sources import tables as tb

from .conftest import SMOKE


@pytest.fixture(scope="module")
def labels(spark):
    return fx.labels_of(spark, SMOKE)


def test_every_row_in_one_fold_and_balanced(spark, labels):
    f = sp.repeated_folds(labels, 3, 4)
    n = labels.count()
    per = f.groupBy("repeat").agg(F.count("*").alias("c"), F.countDistinct("doc_id").alias("d")).collect()
    assert all(r["c"] == n and r["d"] == n for r in per)
    spread = f.groupBy("repeat", "label", "fold").count().groupBy("repeat", "label").agg(
        (F.max("count") - F.min("count")).alias("s")).collect()
    assert all(r["s"] <= 1 for r in spread)


def test_train_test_split_size(spark, labels):
    s = sp.train_test_split(labels, 0.333, 8)
    n = labels.count()
    import math
    assert s.filter(F.col("split") == "test").count() == math.ceil(0.333 * n)


def test_row_norms(spark):
    res = tf.tfidf(tb.records(spark, SMOKE))
    norms = res.matrix.groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-9 for r in norms)
    assert res.vocabulary.agg(F.min("df")).first()[0] >= 3


def test_vectorizer_equals_long_form(spark):
    f = fx.prepare(spark, SMOKE)
    from pyspark.ml.functions import vector_to_array
    dense = f.labelled.select("doc_id", vector_to_array("features").alias("a"))
    long = f.tfidf.matrix
    row = dense.first()
    vals = {r["term_idx"]: r["value"] for r in long.filter(F.col("doc_id") == row["doc_id"]).collect()}
    for i, v in enumerate(row["a"]):
        assert abs(v - vals.get(i, 0.0)) < 1e-9


def test_shap_additivity_linear(spark, labels):
    res = tf.tfidf(tb.records(spark, SMOKE))
    w = md.centroid_weights(res.matrix, labels)
    shap = X.shap_linear(res.matrix, w)
    scores = md.linear_score(res.matrix, w, res.docs)
    assert X.additivity(shap, scores, 0.0).first()["max_abs_error"] < 1e-12


def test_tree_shap_additivity(spark):
    f = fx.prepare(spark, SMOKE)
    model, _ = md.fit(f.labelled, "lightgbm", {"num_iterations": 4, "max_depth": 3}, weight=None)
    base = X.tree_expected_value(spark, model)
    vec = tf.to_vector_arrays(f.tfidf.matrix, f.labels.select("doc_id"))
    shap = X.shap_tree(spark, model, vec)
    scores = md.score(model, f.labelled)
    err = X.additivity(shap, scores, base).first()["max_abs_error"]
    assert err < 1e-9


def test_tree_shap_equals_coalition_sums():
    from itertools import combinations
    from math import factorial

    from screensift.operators.boosting import Growth, fit_forest

    rng = np.random.default_rng(5)
    x = (rng.random((60, 5)) < 0.6) * rng.integers(1, 6, (60, 5)).astype(float)
    y = (x[:, 0] - x[:, 1] * (x[:, 2] > 2) + x[:, 3] > 2).astype(float)

    def sparse(m):
        return np.concatenate([[0], np.cumsum((m != 0).sum(1))]), np.nonzero(m)[1], m[m != 0]

    forest = fit_forest(*sparse(x), y, np.ones(60), Growth(rounds=6, depth=4, l2=0.1, least_hessian=0.1))
    conditions = X.LeafConditions(forest)
    row, feature, phi = conditions.shap(*sparse(x))
    got = np.zeros_like(x)
    got[row, feature] = phi
    assert abs(conditions.base - forest.margin(*sparse(np.zeros((1, 5))))[0]) < 1e-12
    for i in range(20):
        parts = {c: np.where(np.isin(range(5), c), x[i], 0.0) for k in range(6) for c in combinations(range(5), k)}
        value = dict(zip(parts, forest.margin(*sparse(np.array(list(parts.values()))))))
        for j in range(5):
            want = sum(factorial(len(c)) * factorial(4 - len(c)) / factorial(5) * (value[tuple(sorted((*c, j)))] - value[c]) for c in value if j not in c)
            assert abs(got[i, j] - want) < 1e-12


def test_forest_shap_additivity(spark):
    f = fx.prepare(spark, SMOKE)
    model, _ = md.fit(f.labelled, "RandomForestClassifier", {"n_estimators": 6, "max_depth": 4}, weight=None)
    vec = tf.to_vector_arrays(f.tfidf.matrix, f.labels.select("doc_id"))
    shap = X.shap_tree(spark, model, vec)
    err = X.additivity(shap, md.score(model, f.labelled), X.tree_expected_value(spark, model))
    assert err.first()["max_abs_error"] < 1e-9


def test_recall_at_threshold_reaches_target(spark):
    sc = tb.proxy_scores(spark, SMOKE)
    t = M.threshold_for_tpr(sc, [0.9]).filter(F.col("variant") == "exact").first()["threshold"]
    r = M.recall_fpr(M.confusion(sc, t)).first()["recall"]
    assert r >= 0.9


def test_sampled_shap_additivity_rff(spark, labels):
    import math

    import numpy as np

    from screensift.operators import labels as lb

    res = tf.tfidf(tb.records(spark, SMOKE))
    d, gamma = 8, 1.0
    z = md.rff_features(res.matrix, res.docs, gamma=gamma, n_components=d)
    lab = z.join(labels, "doc_id")
    cw = lb.class_weight(labels).first()
    model, _ = md.fit(lab, "SVC", {"kernel": "linear", "C": 10.0}, n_rows=cw["n_pos"] + cw["n_neg"],
                      weight=cw["weight"])
    W, b = X.rff_matrix(spark, res.vocabulary.count(), gamma, d)
    coef = model.coefficients.toArray()
    f0 = math.sqrt(2.0 / d) * np.cos(b) @ coef + model.intercept
    vec = tf.to_vector_arrays(res.matrix, res.docs)
    shap = X.shap_sampled_rff(spark, vec, W, b, coef, model.intercept, n_permutations=3)
    scores = md.score(model, z.join(labels, "doc_id", "left")).select("doc_id", "score")
    assert X.additivity(shap, scores, float(f0)).first()["max_abs_error"] < 1e-9
