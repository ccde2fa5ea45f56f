"""The search tables' AUCs: several labels and all models from one pass over the lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from screensift.operators import metrics as M
from screensift.plans import q_search as qs


def _auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


@pytest.mark.parametrize("n_buckets", [1, 5, None])
def test_aucs_of_several_labels(spark, n_buckets):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), float(rnd.randrange(12)), rnd.randrange(2), rnd.choice([0, 1, None]), rnd.random()) for _ in range(400)]
    rows += [("one", 1.0, 1, 0, 0.5), ("one", 2.0, 1, None, 0.25)]
    df = spark.createDataFrame(rows, "g string, score double, y int, z int, at double")
    got = {r.g: r for r in M.roc_aucs(df, ["y", "z"], ["g"], n_buckets, extremes=["at"]).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, r in got.items():
        mine = [x for x in rows if x[0] == g]
        for i, lab in ((2, "y"), (3, "z")):
            want = _auc([(x[1], x[i]) for x in mine])
            assert r[f"{lab}_auc"] == (None if want is None else pytest.approx(want))
            assert (r[f"{lab}_n_pos"] or 0) == sum(x[i] == 1 for x in mine)
        assert (r.at_min, r.at_max) == (min(x[4] for x in mine), max(x[4] for x in mine))


def test_small_groups_are_shuffled_once(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 7).cast("double").alias("score"), (F.col("id") % 2).cast("int").alias("y"))
    plan = M.roc_aucs(df.repartition("a"), ["y"], ["a", "b"], n_buckets=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_trials_of_own_lines(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.choice([3, 9, 4, None]), rnd.choice([1, 2, 3, 4, None]), float(rnd.randrange(1, 9)), rnd.choice([30000.0, 50000.0, None]), 0.0,
             rnd.choice([0.0, 0.08]), rnd.choice("RN"), rnd.choice("FO"), rnd.choice([dt.datetime(1995, 3, d) for d in (1, 9)] + [dt.datetime(1996, 1, 1), None]))
            for _ in range(300)]
    spark.createDataFrame(rows, "l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    label = {"lightgbm": lambda r: None if r[3] is None else int(r[3] > 40000), "xgboost": lambda r: int(r[5] > 0.04),
             "SVC": lambda r: int(r[6] == "R"), "RandomForestClassifier": lambda r: int(r[7] == "F")}
    want, listed = {}, set()
    for m, f in label.items():
        for year in (1995, 1996, None):
            mine = [r for r in rows if (r[8].year if r[8] else None) == year]
            study = m if year is None else f"{m}/{year}"
            for t, s in enumerate(sorted({r[0] for r in mine}, key=lambda x: (x is not None, x))):
                listed.add((study, t))
                for step in {None if r[1] is None else (r[1] - 1) % 3 for r in mine if r[0] == s} if s is not None else ():
                    auc = _auc([(r[2], f(r)) for r in mine if r[0] == s and (None if r[1] is None else (r[1] - 1) % 3) == step])
                    want[study, t, step] = round(auc or 0.0, 9)
    sf = str(tmp_path)
    assert {(r.study, r.trial) for r in qs.trials(spark, sf).collect()} == listed
    got = {(r.study, r.trial, r.step): r.auc for r in qs.trial_scores(spark, sf).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
