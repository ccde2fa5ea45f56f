"""Batched logistic fits and second-order boosting against plain one-at-a-time versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screensift.operators import batched as B
from screensift.operators import boosting as G

ROW = "doc_id long, label double, indices array<int>, values array<double>, role array<tinyint>"


def sparse_frame(spark, X, y, role):
    rows = [(i, float(y[i]), [int(j) for j in np.nonzero(X[i])[0]], [float(v) for v in X[i][X[i] != 0]], [int(r) for r in role[i]])
            for i in range(len(X))]
    return spark.createDataFrame(rows, ROW).repartition(3)


def plain_logistic(X, y, w, l2, l1, steps=30000):
    """Accelerated proximal gradient on one model."""
    Xb = np.hstack([X, np.ones((len(X), 1))])
    scale = np.linalg.norm(Xb.T * np.sqrt(w / w.sum()), 2) ** 2 / 4 + l2
    t, z, k = np.zeros(Xb.shape[1]), np.zeros(Xb.shape[1]), 1.0
    for _ in range(steps):
        g = Xb.T @ (w * (1 / (1 + np.exp(-Xb @ z)) - y)) / w.sum()
        g[:-1] += l2 * z[:-1]
        new = z - g / scale
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - l1 / scale, 0)
        k2 = (1 + np.sqrt(1 + 4 * k * k)) / 2
        t, z, k = new, new + (k - 1) / k2 * (new - t), k2
    return t


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n, d, m = 160, 20, 4
    X = (rng.random((n, d)) < 0.25) * rng.random((n, d)).round(2)
    y = (X @ rng.normal(size=d) * 2 + rng.normal(size=n) * 0.3 > 0).astype(float)
    role = rng.integers(0, 3, (n, m))
    role[:, 3] = 2  # a model without training rows
    return X, y, role, sparse_frame(spark, X, y, role).persist()


def test_batched_logistic_equals_single_fits(data):
    X, y, role, rows = data
    l2, l1, positive = [0.05, 0.1, 0.02, 0.1], [0.0, 0.0, 0.01, 0.0], [1.0, 2.0, 3.0, 1.0]
    theta = B.fit_logistic_many(rows, X.shape[1], 4, positive, l2, l1, max_iter=300, tol=1e-12)
    blocks = B.fit_logistic_many(rows, X.shape[1], 4, positive, l2, l1, max_iter=300, tol=1e-12, block_cells=2 * (X.shape[1] + 1))
    for m in range(3):
        w = (role[:, m] == 1) * np.where(y > 0, positive[m], 1.0)
        want = plain_logistic(X, y, w, l2[m], l1[m])
        assert np.abs(theta[:, m] - want).max() < 1e-5 and np.abs(blocks[:, m] - want).max() < 1e-5
    assert ((theta[:-1, 2] == 0) == (plain_logistic(X, y, (role[:, 2] == 1) * np.where(y > 0, 3.0, 1.0), 0.02, 0.01)[:-1] == 0)).all()
    assert not theta[:, 3].any()
    got = {(r.model, r.doc_id): (r.split, r.score) for r in B.score_many(rows, theta, 4).collect()}
    assert len(got) == (role > 0).sum()
    for (m, i), (split, score) in got.items():
        assert split == ["none", "train", "valid"][role[i, m]]
        assert abs(score - (X[i] @ theta[:-1, m] + theta[-1, m])) < 1e-9


def test_a_pass_sends_no_more_gradients_than_cores(spark, data, monkeypatch):
    X, y, role, rows = data
    want = B.fit_logistic_many(rows, X.shape[1], 4, l2=0.05, max_iter=300, tol=1e-12)
    parts, start = [], B.Passes.__init__

    def spy(self, *args):
        start(self, *args)
        parts.append(self.parts)

    monkeypatch.setattr(B.Passes, "__init__", spy)
    monkeypatch.setattr(B, "TASK_CELLS", 16)  # small tasks, each with a gradient larger than its work
    monkeypatch.setattr(B, "PARTIAL_CELLS", 100)
    theta = B.fit_logistic_many(rows.repartition(40), X.shape[1], 4, l2=0.05, max_iter=300, tol=1e-12)
    assert parts == [spark.sparkContext.defaultParallelism]
    assert np.abs(theta - want).max() < 1e-5


def test_sum_of_losses_and_empty_rows(spark):
    rows = spark.createDataFrame([(0, 1.0, [], [], [1]), (1, 0.0, [0], [1.0], [1]), (2, 1.0, [], [], [1])], ROW)
    theta = B.fit_logistic_many(rows, 1, 1, l2=0.5, average=False, max_iter=200, tol=1e-13)
    # bias b and weight t: 2 (s(b) - 1) + s(b + t) = 0 and s(b + t) + t / 2 = 0
    b, t = theta[1, 0], theta[0, 0]
    s = lambda z: 1 / (1 + np.exp(-z))
    assert abs(2 * (s(b) - 1) + s(b + t)) < 1e-4 and abs(s(b + t) + t / 2) < 1e-4
    none = B.fit_logistic_many(rows.limit(0), 3, 2, l2=0.1)
    assert none.shape == (4, 2) and not none.any()


def plain_forest(X, y, w, p):
    """Margins after boosting by trying every threshold of every column, zeros absent, best gain first."""
    share = (w @ y + 1e-6) / (w.sum() + 2e-6)
    margin = np.full(len(y), np.log(share / (1 - share)))
    shrunk = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    score = lambda g, h: shrunk(g) ** 2 / (h + p.l2 + 1e-16)

    def best(r, g, h):
        found = None
        for f in range(X.shape[1]):
            values = np.unique(X[r, f][X[r, f] != 0])
            for absent_left in ((True, False) if p.half else (True,)):
                cuts = [-1.0, *values[:-1]] if absent_left else list(values)
                for c in cuts:
                    left = np.where(X[r, f] == 0, absent_left, X[r, f] <= c)
                    if left.all() or not left.any():
                        continue
                    a, b = r[left], r[~left]
                    if min(h[a].sum(), h[b].sum()) < p.least_hessian or min(len(a), len(b)) < p.least_rows:
                        continue
                    gain = score(g[a].sum(), h[a].sum()) + score(g[b].sum(), h[b].sum()) - score(g[r].sum(), h[r].sum())
                    gain = gain / 2 - p.least_gain if p.half else gain
                    if gain > (1e-10 if p.half else max(p.least_gain, 1e-10)) and (found is None or gain > found[0] + 1e-12):
                        found = (gain, a, b)
        return found

    for _ in range(p.rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = w * (q - y), w * q * (1 - q)
        ends = [(np.arange(len(y)), 0)]
        while not p.leaves or len(ends) < p.leaves:
            offers = [(s[0], i, s) for i, (r, d) in enumerate(ends) if (not p.depth or d < p.depth) and (s := best(r, g, h))]
            if not offers:
                break
            _, i, (_, a, b) = max(offers, key=lambda o: o[0])
            d = ends.pop(i)[1] + 1
            ends += [(a, d), (b, d)]
        for r, _ in ends:
            margin[r] += -shrunk(g[r].sum()) / (h[r].sum() + p.l2 + 1e-16) * p.rate
    return margin


@pytest.mark.parametrize("name,params", [
    ("xgboost", {"n_estimators": 4, "max_depth": 3, "reg_lambda": 0.5, "reg_alpha": 0.2, "min_child_weight": 0.3, "gamma": 0.01}),
    ("lightgbm", {"num_iterations": 4, "num_leaves": 5, "lambda_l1": 0.1, "lambda_l2": 0.3, "min_data_in_leaf": 4,
                  "min_sum_hessian_in_leaf": 0.5, "min_gain_to_split": 0.05})])
def test_boosting_equals_plain_version(spark, data, name, params):
    X, y, role, rows = data
    p = G.growth(name, params)
    forests = G.fit_forests(rows, 4, [G.Job(0, 1.5, p), G.Job(1, 1.0, p), G.Job(3, 1.0, p)])
    got = {(r.model, r.doc_id): r.score for r in G.score_forests(rows, forests[:2], 4, [0, 1]).collect()}
    for m, positive in ((0, 1.5), (1, 1.0)):
        keep = np.nonzero(role[:, m] == 1)[0]
        want = plain_forest(X[keep], y[keep], np.where(y[keep] > 0, positive, 1.0), p)
        assert max(abs(got[m, i] - v) for i, v in zip(keep, want)) < 1e-9
    assert not len(forests[2].first)  # no training rows: no trees


def test_bins_leaf_limit_and_sample(spark, data):
    X, y, role, rows = data
    few = G.fit_forests(rows, 4, [G.Job(0, 1.0, G.growth("xgboost", {"n_estimators": 3, "max_bin": 4, "max_leaves": 3}))])[0]
    sizes = np.diff(np.append(few.first, len(few.feature)))
    assert (sizes <= 5).all()  # three leaves, two splits
    part = G.fit_sample(rows, 4, max_rows=40)
    assert 10 < len(part[3]) < 80 and part[4].shape[1] == 4
    whole = G.fit_sample(rows, 4)
    assert len(whole[3]) == len(X) and len(whole[1]) == np.count_nonzero(X)


def test_saved_stage_scores_alike(spark, data, tmp_path):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    X, y, role, rows = data
    forest = G.fit_forests(rows, 4, [G.Job(0, 1.0, G.growth("xgboost", {"n_estimators": 5}))])[0]
    stage = G.BoostedTrees(forest)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    vectors = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "doc_id long, x array<double>").select(
        "doc_id", array_to_vector("x").alias("features"))
    want = {r.doc_id: r.score for r in G.score_forests(rows, [forest], 4, [0]).collect()}
    out = G.BoostedTrees.load(str(tmp_path / "stage")).transform(vectors).select("doc_id", vector_to_array("rawPrediction")[1].alias("score"))
    got = {r.doc_id: r.score for r in out.collect()}
    assert all(abs(got[i] - v) < 1e-9 for i, v in want.items())
    assert vectors.select(F.size(stage.staged_column()).alias("n")).distinct().collect()[0].n == 5
