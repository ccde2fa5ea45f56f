"""The reference's one literal fixture and hand-checked small cases."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from screensift.operators import metrics as M
from screensift.operators import search as H
from screensift.operators.labels import parse_positive


def _scores(spark, y, pred, split):
    return spark.createDataFrame([(split, a, float(b)) for a, b in zip(y, pred)], "split string, label int, score double")


def test_confusion_literal_vectors(spark):
    y_train = [0, 0, 0, 0, 1, 1, 1, 1]
    y_train_pred = [0, 0, 0, 1, 1, 1, 1, 1]
    y_test = [1, 0, 0, 0, 0, 0, 0, 0]
    y_test_pred = [0, 0, 0, 1, 1, 1, 1, 1]
    df = _scores(spark, y_train, y_train_pred, "train").unionByName(_scores(spark, y_test, y_test_pred, "test"))
    got = {r["split"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in M.confusion(df, 0.5, ["split"]).collect()}
    assert got["train"] == (3, 1, 0, 4)
    assert got["test"] == (2, 5, 1, 0)
    layout = {(r["split"], r["row"], r["col"]): r["cell"] for r in
              M.confusion_layout(M.confusion(df, 0.5, ["split"]), ["split"]).collect()}
    assert layout[("train", 0, 0)] == "fp" and layout[("train", 1, 1)] == "fn"


def test_auc_ties_and_one_class(spark):
    tied = spark.createDataFrame([(0, 1.0), (1, 1.0), (0, 1.0), (1, 1.0)], "label int, score double")
    assert M.roc_auc(tied).first()["auc"] == pytest.approx(0.5)
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert M.roc_auc(one).first()["auc"] is None
    two = spark.createDataFrame([(0, 0.1), (1, 0.9)], "label int, score double")
    assert M.roc_auc(two).first()["auc"] == pytest.approx(1.0)


def test_roc_thinning_and_tpr_threshold(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.5), (0, 0.4), (1, 0.3)]
    df = spark.createDataFrame(rows, "label int, score double")
    full = M.roc_curve(df, drop_intermediate=False).orderBy(F.desc("threshold")).collect()
    thin = M.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert full[0]["threshold"] == math.inf and len(full) == 8
    # the first distinct score is always kept; 0.5 lies on the segment 0.6 -> 0.4 and is dropped
    assert [r["threshold"] for r in thin] == [math.inf, 0.9, 0.8, 0.7, 0.6, 0.4, 0.3]
    t = {r["target"]: r["threshold"] for r in M.threshold_for_tpr(df, [1.0, 0.5]).filter(
        F.col("variant") == "exact").collect()}
    assert t[1.0] == 0.3 and t[0.5] == 0.8


def test_average_precision_step(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7)], "label int, score double")
    ap = M.average_precision(df).first()["average_precision"]
    assert ap == pytest.approx(0.5 * 1.0 + 0.5 * (2 / 3))


def test_parse_positive():
    assert parse_positive("1") == 1 and isinstance(parse_positive("1"), int)
    assert parse_positive("1.5") == 1.5
    assert parse_positive("CaseControlStudies") == "CaseControlStudies"


def _brute_p_less(d):
    n = len(d)
    ranks = sorted(range(n), key=lambda i: abs(d[i]))
    r = [0.0] * n
    for pos, i in enumerate(ranks):
        r[i] = pos + 1
    obs = sum(r[i] for i in range(n) if d[i] > 0)
    tot = 0
    le = 0
    for signs in itertools.product([0, 1], repeat=n):
        t = sum(r[i] for i in range(n) if signs[i])
        tot += 1
        le += t <= obs + 1e-9
    return obs, le / tot


def test_wilcoxon_exact_matches_enumeration():
    d = [0.05, -0.02, -0.07, 0.01, -0.04, -0.09]
    obs, p = _brute_p_less(d)
    assert H.signed_rank_p_less(len(d), obs, 0.0, True) == pytest.approx(p)


def test_wilcoxon_normal_approximation():
    p = H.signed_rank_p_less(20, 105.0, 0.0, False)
    assert p == pytest.approx(0.5)


def test_density_curves_integrate_to_one(spark):
    import random

    rnd = random.Random(3)
    rows = [(i % 2, rnd.gauss(0.3 + 0.4 * (i % 2), 0.1)) for i in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    for kind in ("kde", "normal"):
        d = M.score_density(df, ["label"], curve_type=kind).groupBy("label").agg(
            (F.sum("density") * ((F.max("x") - F.min("x")) / 499)).alias("area")).collect()
        # the grid spans min..max only, so the tails are cut off: most of the mass is inside
        assert all(0.85 < r["area"] < 1.05 for r in d), (kind, d)


def test_threshold_for_recall_hand_case(spark):
    # sorted desc: 0.9(1) 0.8(0) 0.7(1) 0.6(1) 0.5(0); cumulative recall 0, 1/3, 1/3, 2/3, 1, 1
    rows = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.7), (4, 1, 0.6), (5, 0, 0.5)]
    df = spark.createDataFrame(rows, "k long, label int, score double")
    g = M.cumulative_gains(df, ["k"])
    got = {r["recall"]: r["threshold"] for r in M.threshold_for_recall(g, [50.0, 100.0]).collect()}
    # 50 %: last i < n with 100*y_i < 50 is i = 2 -> threshold of row 3 = 0.7
    # 100 %: last i < n with 100*y_i < 100 is i = 3 -> threshold of row 4 = 0.6
    assert got == {50.0: 0.7, 100.0: 0.6}


def test_density_split_interpolates(spark):
    d = spark.createDataFrame([(0, i, float(i), float(i * i)) for i in range(4)],
                              "label int, i int, x double, density double")
    out = {(r["side"], r["seq"]): (r["x"], r["y"]) for r in M.density_split(d, 1.5, ["label"]).collect()}
    assert out[("below", 2)] == (1.5, 2.5) and out[("above", 2)] == (1.5, 2.5)   # between (1,1) and (2,4)
    assert out[("below", 0)] == (0.0, 0.0) and out[("above", 3)] == (2.0, 4.0)
