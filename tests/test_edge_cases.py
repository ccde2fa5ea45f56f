"""Edge cases from the fixture list: blanks, nulls, accents, empty vocabulary, ranges."""

import pytest
from pyspark.sql import functions as F

from screensift.functions.text import strip_accents_col
from screensift.operators import labels as lb
from screensift.operators import search as H
from screensift.operators import tfidf as tf

REC = "doc_id long, title string, abstract string"


def test_empty_rows_detected(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "    ", None), (3, "", "\t"), (4, "a", "")], REC)
    assert sorted(r["doc_id"] for r in lb.empty_rows(df).collect()) == [2, 3]
    with pytest.raises(ValueError):
        lb.check_no_empty_rows(df)


def test_binarize_text_and_numeric(spark):
    t = spark.createDataFrame([(1, "1"), (2, "0"), (3, None), (4, "1.0")], "doc_id long, label string")
    assert [r["label"] for r in lb.binarize(t, "label", "1").orderBy("doc_id").collect()] == [1, 0, 0, 1]
    n = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    assert [r["label"] for r in lb.binarize(n, "label", 1).orderBy("doc_id").collect()] == [1, 0]


def test_class_weight_needs_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "label int")
    with pytest.raises(Exception):
        lb.class_weight(df).collect()


def test_accents(spark):
    df = spark.createDataFrame([("Café naïve Ærø é",)], "t string")
    assert df.select(strip_accents_col(F.col("t"))).first()[0] == "Cafe naive Ærø e"


def test_no_term_survives_min_df(spark):
    df = spark.createDataFrame([(1, "alpha", None), (2, "beta", None)], REC)
    res = tf.tfidf(df, tf.TfidfOptions(min_df=3))
    assert res.vocabulary.count() == 0 and res.matrix.count() == 0
    vec = tf.to_vector_arrays(res.matrix, res.docs).collect()
    assert len(vec) == 2 and all(len(r["indices"]) == 0 for r in vec)


def test_duplicates_and_border_ngrams(spark):
    df = spark.createDataFrame([(i, "deep nets", "learn fast") for i in range(3)], REC)
    res = tf.tfidf(df, tf.TfidfOptions(min_df=3))
    terms = {r["term"] for r in res.vocabulary.collect()}
    assert "t_nets a_learn" in terms and "t_deep t_nets a_learn" in terms


def test_absent_parent_drops_child(spark):
    trials = spark.createDataFrame([("s", "xgboost", 0)], "study string, model string, trial int")
    rng = spark.createDataFrame([("xgboost", "top_k", "int", 1.0, 5.0, False, None, None),
                                 ("xgboost", "booster", "singular", None, None, None, "gblinear", None)],
                                H.RANGE_SCHEMA)
    act = H.active_params(H.draw_candidates(trials, rng), H.dependencies(spark))
    # top_k needs booster in [gblinear] and feature_selector in [greedy, thrifty]; the latter is absent
    assert {r["param"] for r in act.collect()} == {"booster"}


def test_log_range_draws_inside(spark):
    trials = spark.range(200).select(F.lit("s").alias("study"), F.lit("SVC").alias("model"),
                                     F.col("id").cast("int").alias("trial"))
    c = H.draw_candidates(trials, H.default_ranges(spark).filter(F.col("param") == "C"))
    r = c.agg(F.min("value_num"), F.max("value_num")).first()
    assert 1e-3 <= r[0] and r[1] <= 1e5


def test_lemmatized_features(spark):
    from screensift.operators import text as tt

    df = spark.createDataFrame([(i, "model", "models studies study") for i in range(3)], REC)
    lem = tt.lemma_table(tt.tokens(df))
    assert {(r["token"], r["lemma"]) for r in lem.collect()} == {("models", "model"), ("studies", "study")}
    res = tf.tfidf(df, tf.TfidfOptions(min_df=3), lemmas=lem)
    terms = {r["term"] for r in res.vocabulary.collect()}
    assert "a_model a_study a_study" in terms and "a_models" not in terms


def test_tsv_round_trip_with_na_and_quoting(spark):
    from screensift.session import scratch_path
    from screensift.sources import files as io

    rows = [("A title", "line one\nline two\twith tab", "1"), ("NA", "n/a", "0"), ("  spaced  ", None, None)]
    df = spark.createDataFrame(rows, "PaperTitle string, Abstract string, Label string")
    path = scratch_path(spark, "tsv-test")
    io.write_tsv(df.coalesce(1), path)
    back = io.read_labelled(spark, path, "PaperTitle", "Abstract", "Label").orderBy("doc_id").collect()
    assert back[0]["abstract"] == "line one\nline two\twith tab"
    assert back[1]["title"] is None and back[1]["abstract"] is None      # pandas-style missing values
    assert back[2]["title"] == "  spaced  " and back[2]["label"] is None
    lab = lb.binarize(io.read_labelled(spark, path, "PaperTitle", "Abstract", "Label"), "label", "1")
    assert sorted(r["label"] for r in lab.collect()) == [0, 0, 1]


def test_stop_rules_and_range_merge(spark):
    trials = spark.createDataFrame([("s", "SVC", t, "COMPLETE", 100.0 + 10 * t, 105.0 + 10 * t) for t in range(6)],
                                   "study string, model string, trial int, state string, started double, "
                                   "finished double")
    obj = spark.createDataFrame([("s", t, 0.5 + 0.01 * t) for t in range(6)], "study string, trial int, objective double")
    rules = {r["rule"]: r["stop_trial"] for r in H.stop_rules(trials, obj, 4, None, 30.0).collect()}
    assert rules == {"max_trials": 3, "timeout": 3}   # 4th trial counted; trial 3 finishes at 135 >= 100 + 30
    user = spark.createDataFrame([("SVC", "C", "float", 1.0, 2.0, False, None, None)], H.RANGE_SCHEMA)
    merged = {r["param"]: r for r in H.merge_ranges(H.default_ranges(spark), user).filter(
        F.col("model") == "SVC").collect()}
    assert merged["C"]["high"] == 2.0 and merged["C"]["log"] is False and merged["gamma"]["high"] == 1000.0


def test_learning_proportions_and_holdout_allocation(spark):
    from screensift.operators import splits as sp

    small = spark.createDataFrame([(i, 1 if i < 12 else 0) for i in range(40)], "doc_id long, label int")
    props = sorted(r["proportion"] for r in sp.learning_proportions(small).collect())
    assert props[0] == 0.2 and len(props) == 9          # 12 positives < 13: 0.1 is dropped
    big = spark.createDataFrame([(i, 1 if i < 13 else 0) for i in range(40)], "doc_id long, label int")
    assert len(sp.learning_proportions(big).collect()) == 10
    # 40 rows, test = ceil(0.333 * 40) = 14; train 26 split 12 positives : 28 negatives by largest remainder
    s = sp.train_test_split(small, 0.333, 8).groupBy("split", "label").count().collect()
    got = {(r["split"], r["label"]): r["count"] for r in s}
    assert got[("test", 0)] + got[("test", 1)] == 14
    assert got[("train", 1)] == 8 and got[("train", 0)] == 18   # 26*12/40 = 7.8 -> 8, 26*28/40 = 18.2 -> 18


def test_svc_conditional_parameters(spark):
    trials = spark.range(200).select(F.lit("s").alias("study"), F.lit("SVC").alias("model"),
                                     F.col("id").cast("int").alias("trial"))
    act = H.active_params(H.draw_candidates(trials, H.default_ranges(spark)), H.dependencies(spark)).collect()
    by = {}
    for r in act:
        by.setdefault(r["trial"], {})[r["param"]] = r["value_str"]
    kernels = set()
    for t, p in by.items():
        k = p["kernel"]
        kernels.add(k)
        assert ("gamma" in p) == (k in ("rbf", "sigmoid"))
        assert ("coef0" in p) == (k == "sigmoid")
        assert "degree" not in p                     # poly is not among the default choices
    assert kernels == {"linear", "rbf", "sigmoid"}
