"""The centroid model's repeated cross-validation moves no matrix entry."""

import re

import pytest

from screensift.operators import splits as sp
from screensift.operators import tfidf as tf
from screensift.plans import features as fx
from screensift.plans import q_models as qm
from screensift.sources import tables as tb


@pytest.fixture
def tables(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    docs = [(i, f"{words[i % 10]} {words[i * 3 % 7]}\n" + " ".join(words[(i * k) % (5 + i % 5)] for k in range(1, 9))) for i in range(60)]
    docs += [(3, docs[3][1]), (60, None)]
    labs = [(i, 0, int(i % 3 == 0)) for i in range(45)] + [(5, 0, 1), (6, 0, 1), (100, 0, 0)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labs, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_scores_of_held_out_documents(spark, tables):
    res = tf.tfidf(tb.records(spark, tables))
    entries = [tuple(r) for r in res.matrix.select("doc_id", "term_idx", "value").collect()]
    folds = [tuple(r) for r in sp.repeated_folds(fx.labels_of(spark, tables), 3, 3).select("repeat", "fold", "doc_id", "label").collect()]
    want = []
    for r, f, d, y in folds:
        train = [(dd, yy) for rr, ff, dd, yy in folds if rr == r and ff != f]
        w = {}
        for y_, sign in ((1, 1.0), (0, -1.0)):
            n = sum(yy == y_ for _, yy in train)
            for dd, t, x in entries:
                k = sum(dd == d2 and yy == y_ for d2, yy in train)
                if k:
                    w[t] = w.get(t, 0.0) + sign * k * x / n
        same = sum((rr, ff, dd) == (r, f, d) for rr, ff, dd, _ in folds)
        want.append((r, f, d, y, same * sum(x * w.get(t, 0.0) for dd, t, x in entries if dd == d)))
    got = sorted(tuple(x) for x in qm.centroid_cv_scores(spark, tables).select("repeat", "fold", "doc_id", "label", "score").collect())
    assert [x[:4] for x in got] == [x[:4] for x in sorted(want)]
    assert [x[4] for x in got] == pytest.approx([x[4] for x in sorted(want)], abs=1e-8)


def test_no_entry_is_copied_per_repeat(spark, tables):
    plan = qm.centroid_cv_scores(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "term_idx" in plan and "_valid" in plan
    assert not re.search(r"hashpartitioning\(repeat#\d+, fold#\d+, term_idx", plan)


def test_learning_curve_of_repeated_rows(spark, tables):
    """Scores of both sides per (fold, proportion) against sums over all pairs, label rows and vectors that repeat included."""
    from screensift.operators import metrics as M
    from screensift.operators import models as md

    res, labels = tf.tfidf(tb.records(spark, tables)), fx.labels_of(spark, tables)
    g = ("fold", "proportion")
    subsets = sp.learning_subsets(labels).cache()
    w = md.centroid_weights(res.matrix, subsets, g)
    val = sp.stratified_folds(labels, 5, 42).join(subsets.select(*g).distinct(), "fold")
    want = {}
    for rows, at in ((subsets, 0), (val, 1)):
        scores = md.linear_score(res.matrix, w, rows, groups=g).selectExpr(*g, "label", "round(score, 9) AS score")
        for r in M.roc_auc(scores, list(g)).collect():
            want.setdefault((r.fold, r.proportion), [None, None, 0])[at] = r.auc
            want[r.fold, r.proportion][2] += 0 if at else r.n_pos + r.n_neg
    got = {(r.fold, r.proportion): [r.train_auc, r.val_auc, r.train_size] for r in qm.centroid_learning_curve(spark, tables).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_no_entry_is_copied_per_proportion(spark, tables):
    plan = qm.centroid_learning_curve(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "term_idx" in plan and not re.search(r"hashpartitioning\(fold#\d+, proportion#\d+, term_idx", plan)
