"""Queries: model fit/score (M*), cross-validation (E20-E24), classification."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from screensift.operators import cv
from screensift.operators import labels as lb
from screensift.operators import metrics as M
from screensift.operators import models as md
from screensift.operators import splits as sp
from screensift.operators import tfidf as tf
from screensift.operators.fits import class_counts
from screensift.plans import features as fx
from screensift.plans.q_splits import SQL_SUBSETS, sql_folds
from screensift.plans.registry import register
from screensift.plans.sql_metrics import ctes_cum
from screensift.plans.sql_models import LAB, ctes_centroid_scores, sql_auc
from screensift.plans.sql_text import ctes_tfidf, r6
from screensift.sources import tables as tb
from screensift.sources.tables import SQL_PROXY_SCORES, proxy_scores

CV_FOLDS, CV_REPEATS = 3, 3
#: The linear booster with a ridge penalty (without one, separable rows have no finite fit); all else by default.
LINEAR = {"booster": "gblinear", "reg_lambda": 1e-3}


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---- Spark ML fits (rows-only checks) ------------------------------------------------

def _fit_and_score(spark, sf, model_name, params):
    f = fx.prepare(spark, sf)
    cw = lb.class_weight(f.labels).first()
    n = cw["n_pos"] + cw["n_neg"]
    model, _ = md.fit(f.labelled, model_name, params, n_rows=n, weight=cw["weight"])
    return md.score(model, f.labelled).select("doc_id", "label", "score")


@register("fit_model")
def q_fit_model(spark, sf):
    return _fit_and_score(spark, sf, "lightgbm", {})


@register("fit_gbt")
def q_fit_gbt(spark, sf):
    return _fit_and_score(spark, sf, "xgboost", {})


@register("fit_linear")
def q_fit_linear(spark, sf):
    return _fit_and_score(spark, sf, "xgboost", {"booster": "gblinear", "reg_lambda": 1.0, "reg_alpha": 1e-4})


@register("fit_forest")
def q_fit_forest(spark, sf):
    return _fit_and_score(spark, sf, "RandomForestClassifier", {})


@register("fit_svc")
def q_fit_svc(spark, sf):
    return _fit_and_score(spark, sf, "SVC", {"kernel": "linear", "C": 1.0})


@register("fit_svc_rbf")
def q_fit_svc_rbf(spark, sf):
    return _fit_and_score(spark, sf, "SVC", {"kernel": "rbf", "C": 10.0, "gamma": 1.0})


@register("score_rows")
def q_score_rows(spark, sf):
    f = fx.prepare(spark, sf)
    model, _ = md.fit(f.labelled, "xgboost", LINEAR, n_rows=f.labelled.count())
    return md.raw_threshold_predict(model, f.unlabelled, 0.0).select("doc_id", "score", "pred")


@register("cv_scores")
def q_cv_scores(spark, sf):
    f = fx.prepare(spark, sf)
    return cv.cv_scores(spark, f.labelled, f.labels, "xgboost", LINEAR)


@register("cv_metrics")
def q_cv_metrics(spark, sf):
    f = fx.prepare(spark, sf)
    return cv.cv_metrics(spark, f.labelled, f.labels, "xgboost", LINEAR, repeats=2, threshold=0.0)


@register("learning_curve")
def q_learning_curve(spark, sf):
    f = fx.prepare(spark, sf)
    return cv.learning_curve(spark, f.labelled, f.labels, "xgboost", LINEAR)


@register("auc_by_iteration")
def q_auc_by_iteration(spark, sf):
    f = fx.prepare(spark, sf)
    model, _ = md.fit(f.labelled, "lightgbm", {}, weight=None)
    return cv.auc_by_iteration(model, f.labelled)


# ---- closed-form linear model (SQL-checked) ------------------------------------------

@register("linear_score", f"""WITH {ctes_centroid_scores()}
SELECT doc_id, {r6('score')} AS score FROM cscores""")
def q_linear_score(spark, sf):
    s = fx.centroid_scores(spark, sf)
    return s.select("doc_id", R("score").alias("score"))


@register("threshold_predict", f"""WITH {ctes_centroid_scores()}
SELECT doc_id, label, {r6('score')} AS score, CAST(score >= 0.0 AS INTEGER) AS pred
FROM cscores WHERE label IS NOT NULL""")
def q_threshold_predict(spark, sf):
    s = fx.centroid_scores(spark, sf).filter(F.col("label").isNotNull())
    p = lb.threshold_predict(s, 0.0)
    return p.select("doc_id", "label", R("score").alias("score"), "pred")


@register("classify_unlabelled", f"""WITH {ctes_centroid_scores()}
SELECT doc_id, {r6('score')} AS score, CAST(score >= 0.0 AS INTEGER) AS pred
FROM cscores WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_classify_unlabelled(spark, sf):
    from screensift.plans.jobs import classify_with_weights
    return classify_with_weights(spark, sf, 0.0)


def centroid_cv_scores(spark, sf, nfolds=CV_FOLDS, repeats=CV_REPEATS):
    """Validation scores of the centroid model per (repeat, fold).

    A document's folds of all repeats are one row beside its vector, so every
    entry is read once for all (repeat, fold) models: a term's training sums are
    one row, a document's scores one sum per model, and no entry is copied or
    shuffled; a shuffle moves a row a term or a row a document of each task.
    """
    res = tf.tfidf(tb.records(spark, sf))
    labels = fx.labels_of(spark, sf)
    # consumed by three branches below: computed once
    folds = sp.repeated_folds(labels, nfolds, repeats).persist(StorageLevel.MEMORY_AND_DISK)
    counts = class_counts(folds, ["repeat", "fold"])  # repeats x folds, bounded
    models = [(r, f) for r in range(repeats) for f in range(nfolds)]

    def times(test):
        """How often a document is dealt to each model: a label row counts once."""
        return F.array(*[F.sum(test(r, f).cast("double")) for r, f in models])

    def trained(y):
        return lambda r, f: (F.col("label") == y) & (F.col("repeat") == r) & (F.col("fold") != f)

    dealt = folds.groupBy("doc_id").agg(times(trained(1)).alias("pos"), times(trained(0)).alias("neg"),
                                        times(lambda r, f: (F.col("repeat") == r) & (F.col("fold") == f)).alias("valid"))
    v = F.unwrap_udt("features")
    rows = res.vectors.join(dealt, "doc_id").select(
        "doc_id", "pos", "neg", "valid", v["indices"].alias("term_idx"), v["values"].alias("value")).persist(StorageLevel.MEMORY_AND_DISK)
    entries = rows.select("doc_id", "pos", "neg", "valid", F.inline(F.arrays_zip("term_idx", "value")))
    sums = entries.groupBy("term_idx").agg(*[F.sum(F.col("value") * F.col(c)[i]).alias(f"{c}_{i}")
                                             for c in ("pos", "neg") for i in range(len(models))])

    def mean(c, i, y):
        r, f = models[i]
        n = sum(k[y] for (rr, ff), k in counts.items() if rr == r and ff != f)
        return F.col(f"{c}_{i}") / F.lit(float(n)) if n else F.lit(0.0)

    # one row per vocabulary term (bounded by max_features)
    weights = sums.select("term_idx", F.array(*[mean("pos", i, 1) - mean("neg", i, 0) for i in range(len(models))]).alias("w"))
    s = entries.select("doc_id", "valid", "term_idx", "value").join(F.broadcast(weights), "term_idx").groupBy("doc_id").agg(
        F.first("valid").alias("_valid"), F.array(*[F.sum(F.col("value") * F.col("w")[i]) for i in range(len(models))]).alias("_s"))
    at = F.col("repeat") * nfolds + F.col("fold")
    out = folds.join(s, "doc_id", "left").select(
        "repeat", "fold", "doc_id", "label", F.round(F.coalesce(F.get("_valid", at) * F.get("_s", at), F.lit(0.0)), 9).alias("score"))
    return out.persist(StorageLevel.MEMORY_AND_DISK)  # a number a document and repeat, read by every metric


SQL_CV = f"""{ctes_tfidf()},
{LAB},
rl AS (SELECT CAST(rep AS INTEGER) AS repeat, doc_id, label FROM lab, range({CV_REPEATS}) t(rep)),
{sql_folds(CV_FOLDS, "repeat", "repeat", "rl")},
tr AS (SELECT f.repeat, CAST(v.vfold AS INTEGER) AS fold, f.doc_id, f.label
       FROM folds f, range({CV_FOLDS}) v(vfold) WHERE f.fold <> v.vfold),
trn AS (SELECT repeat, fold, count_if(label = 1) AS np, count_if(label = 0) AS nn FROM tr GROUP BY repeat, fold),
cvw AS (SELECT tr.repeat, tr.fold, t.term_idx,
    coalesce(sum(CASE WHEN tr.label = 1 THEN t.value ELSE 0.0 END) / nullif(max(trn.np), 0), 0.0)
  - coalesce(sum(CASE WHEN tr.label = 0 THEN t.value ELSE 0.0 END) / nullif(max(trn.nn), 0), 0.0) AS weight
  FROM tr JOIN tfidf t USING (doc_id) JOIN trn USING (repeat, fold) GROUP BY tr.repeat, tr.fold, t.term_idx),
vs AS (SELECT f.repeat, f.fold, f.doc_id, sum(t.value * w.weight) AS s
       FROM folds f JOIN tfidf t USING (doc_id)
       JOIN cvw w ON w.repeat = f.repeat AND w.fold = f.fold AND w.term_idx = t.term_idx
       GROUP BY f.repeat, f.fold, f.doc_id),
cvs AS (SELECT f.repeat, f.fold, f.doc_id, f.label, round(coalesce(vs.s, 0.0), 9) AS score
        FROM folds f LEFT JOIN vs USING (repeat, fold, doc_id)),
{sql_auc("cv_auc", "cvs", ["repeat", "fold"])},
cv_conf AS (SELECT repeat, fold, count_if(label = 0 AND score < 0.0) AS tn, count_if(label = 0 AND score >= 0.0) AS fp,
   count_if(label = 1 AND score < 0.0) AS fn, count_if(label = 1 AND score >= 0.0) AS tp FROM cvs GROUP BY repeat, fold),
cvm AS (SELECT repeat, fold, a.auc,
   coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
   1.0 - coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS fpr
   FROM cv_conf JOIN cv_auc a USING (repeat, fold))"""


@register("cv_metrics_from_scores", f"""WITH {SQL_CV}
SELECT repeat, fold, {r6('auc')} AS auc, {r6('recall')} AS recall, {r6('fpr')} AS fpr FROM cvm""")
def q_cv_metrics_from_scores(spark, sf):
    m = cv.cv_metrics_from_scores(centroid_cv_scores(spark, sf), threshold=0.0)
    return m.select("repeat", "fold", R("auc").alias("auc"), R("recall").alias("recall"), R("fpr").alias("fpr"))


@register("threshold_report", f"""WITH {SQL_CV},
long AS (SELECT 'auc' AS metric, auc AS v FROM cvm UNION ALL SELECT 'recall', recall FROM cvm
         UNION ALL SELECT 'fpr', fpr FROM cvm)
SELECT metric, {r6('avg(v)')} AS mean, {r6('median(v)')} AS median, {r6('stddev_pop(v)')} AS std,
       {r6('min(v)')} AS min, {r6('max(v)')} AS max, count(v) AS n FROM long GROUP BY metric""")
def q_threshold_report(spark, sf):
    from screensift.plans.jobs import threshold_report
    rep = threshold_report(centroid_cv_scores(spark, sf), 0.0)
    return rep.select("metric", *[R(c).alias(c) for c in ("mean", "median", "std", "min", "max")], "n")


@register("cv_metrics_per_model", f"""WITH {SQL_PROXY_SCORES},
{ctes_cum(("model",))},
thr AS (SELECT model, max(score) AS threshold FROM cc WHERE CAST(tps AS DOUBLE) / P >= 0.9 GROUP BY model),
sj AS (SELECT s.*, t.threshold FROM scores s JOIN thr t USING (model)),
conf AS (SELECT model, fold, count_if(label = 0 AND score < threshold) AS tn,
   count_if(label = 0 AND score >= threshold) AS fp, count_if(label = 1 AND score < threshold) AS fn,
   count_if(label = 1 AND score >= threshold) AS tp FROM sj GROUP BY model, fold),
{sql_auc("pm_auc", "scores", ["model", "fold"])}
SELECT model, fold, {r6('a.auc')} AS auc,
  {r6('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)')} AS recall,
  {r6('1.0 - coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0)')} AS fpr
FROM conf JOIN pm_auc a USING (model, fold)""")
def q_cv_metrics_per_model(spark, sf):
    sc = proxy_scores(spark, sf)
    thr = M.threshold_for_tpr(sc, [0.9], ["model"]).filter(F.col("variant") == "exact").select(
        "model", "threshold")
    m = cv.cv_metrics_per_model(sc, thr)
    return m.select("model", "fold", R("auc").alias("auc"), R("recall").alias("recall"), R("fpr").alias("fpr"))


def centroid_learning_curve(spark, sf):
    """Learning curve of the centroid model: (proportion, fold, train_size, train_auc, val_auc).

    As in centroid_cv_scores, a document's shares in all (fold, proportion) models
    are one row beside its vector, so no entry is copied or shuffled for a model.
    """
    res = tf.tfidf(tb.records(spark, sf))
    labels = fx.labels_of(spark, sf)
    # read by the weights, both scorers and the proportion list: computed once
    subsets = sp.learning_subsets(labels).persist(StorageLevel.MEMORY_AND_DISK)
    folds = sp.stratified_folds(labels, 5, 42)
    g = ("fold", "proportion")
    counts = class_counts(subsets, list(g))  # folds x proportions, bounded
    models = sorted(counts)
    rows = [(f, p, i, *(1.0 / n if n else 0.0 for n in counts[f, p])) for i, (f, p) in enumerate(models)]
    numbered = F.broadcast(spark.createDataFrame(rows, "fold int, proportion double, at int, neg double, pos double"))
    mine = subsets.join(numbered, list(g))
    # what a document adds to a model's weights, and how often a model's scores count it: a label row counts once
    adds = F.when(F.col("label") == 1, F.col("pos")).when(F.col("label") == 0, -F.col("neg"))
    dealt = mine.groupBy("doc_id").agg(F.array(*[F.sum(F.when(F.col("at") == i, adds).otherwise(0.0)) for i in range(len(models))]).alias("adds"),
                                       F.array(*[F.count_if(F.col("at") == i) for i in range(len(models))]).alias("train"))
    valid = folds.groupBy("doc_id").agg(F.array(*[F.count_if(F.col("fold") == f) for f in range(5)]).alias("valid"))
    v = F.unwrap_udt("features")
    none = F.array(*[F.lit(0.0) for _ in models])
    vectors = res.vectors.join(valid.join(dealt, "doc_id", "left"), "doc_id").select(
        "doc_id", F.coalesce("adds", none).alias("adds"), "train", "valid", v["indices"].alias("term_idx"), v["values"].alias("value")).persist(
        StorageLevel.MEMORY_AND_DISK)
    entries = vectors.select("doc_id", "adds", F.inline(F.arrays_zip("term_idx", "value")))
    # one row per vocabulary term (bounded by max_features)
    weights = entries.groupBy("term_idx").agg(F.array(*[F.sum(F.col("value") * F.col("adds")[i]) for i in range(len(models))]).alias("w"))
    s = entries.select("doc_id", "term_idx", "value").join(F.broadcast(weights), "term_idx").groupBy("doc_id").agg(
        F.array(*[F.sum(F.col("value") * F.col("w")[i]) for i in range(len(models))]).alias("_s"))
    times = vectors.groupBy("doc_id").agg(F.first("train").alias("_train"), F.first("valid").alias("_valid"))
    s = s.join(times, "doc_id").persist(StorageLevel.MEMORY_AND_DISK)  # a number a document and model, read by both scorers

    def scored(rows, times):
        score = F.round(F.coalesce(times * F.get("_s", F.col("at")), F.lit(0.0)), 9)
        return rows.join(s, "doc_id", "left").select(*g, "doc_id", "label", score.alias("score")).persist(StorageLevel.MEMORY_AND_DISK)

    tr = scored(mine.select(*g, "doc_id", "label", "at"), F.get("_train", F.col("at")))
    va = scored(folds.join(numbered, "fold").select(*g, "doc_id", "label", "at"), F.get("_valid", F.col("fold")))
    tra = M.roc_auc(tr, list(g)).select(*g, F.col("auc").alias("train_auc"),
                                        (F.col("n_pos") + F.col("n_neg")).alias("train_size"))
    vaa = M.roc_auc(va, list(g)).select(*g, F.col("auc").alias("val_auc"))
    return tra.join(vaa, list(g))


@register("learning_curve_bands", f"""WITH {SQL_SUBSETS},
{ctes_tfidf()},
sn AS (SELECT fold, proportion, count_if(label = 1) AS np, count_if(label = 0) AS nn FROM subsets GROUP BY ALL),
lw AS (SELECT s.fold, s.proportion, t.term_idx,
    coalesce(sum(CASE WHEN s.label = 1 THEN t.value ELSE 0.0 END) / nullif(max(sn.np), 0), 0.0)
  - coalesce(sum(CASE WHEN s.label = 0 THEN t.value ELSE 0.0 END) / nullif(max(sn.nn), 0), 0.0) AS weight
  FROM subsets s JOIN tfidf t USING (doc_id) JOIN sn USING (fold, proportion)
  GROUP BY s.fold, s.proportion, t.term_idx),
lv AS (SELECT f.fold, p.proportion, f.doc_id, f.label FROM folds f JOIN (SELECT DISTINCT fold, proportion FROM subsets) p
       USING (fold)),
ltr_s AS (SELECT s.fold, s.proportion, s.doc_id, sum(t.value * w.weight) AS s FROM subsets s JOIN tfidf t USING (doc_id)
          JOIN lw w ON w.fold = s.fold AND w.proportion = s.proportion AND w.term_idx = t.term_idx GROUP BY ALL),
ltr AS (SELECT s.fold, s.proportion, s.label, round(coalesce(x.s, 0.0), 9) AS score
        FROM subsets s LEFT JOIN ltr_s x USING (fold, proportion, doc_id)),
lva_s AS (SELECT s.fold, s.proportion, s.doc_id, sum(t.value * w.weight) AS s FROM lv s JOIN tfidf t USING (doc_id)
          JOIN lw w ON w.fold = s.fold AND w.proportion = s.proportion AND w.term_idx = t.term_idx GROUP BY ALL),
lva AS (SELECT s.fold, s.proportion, s.label, round(coalesce(x.s, 0.0), 9) AS score
        FROM lv s LEFT JOIN lva_s x USING (fold, proportion, doc_id)),
{sql_auc("tra", "ltr", ["fold", "proportion"])},
{sql_auc("vaa", "lva", ["fold", "proportion"])},
sizes AS (SELECT fold, proportion, count(*) AS train_size FROM subsets GROUP BY ALL),
curve AS (SELECT fold, proportion, train_size, tra.auc AS train_auc, vaa.auc AS val_auc
          FROM sizes JOIN tra USING (fold, proportion) JOIN vaa USING (fold, proportion))
SELECT proportion, {r6('avg(train_size)')} AS mean_train_size, {r6('avg(train_auc)')} AS train_auc_mean,
  {r6('avg(val_auc)')} AS val_auc_mean, {r6('min(val_auc)')} AS val_auc_min, {r6('max(val_auc)')} AS val_auc_max,
  {r6('stddev_pop(val_auc)')} AS val_auc_std FROM curve GROUP BY proportion""")
def q_learning_curve_bands(spark, sf):
    b = cv.learning_curve_bands(centroid_learning_curve(spark, sf))
    cols = ["mean_train_size", "train_auc_mean", "val_auc_mean", "val_auc_min", "val_auc_max", "val_auc_std"]
    return b.select("proportion", *[R(c).alias(c) for c in cols])


@register("fold_rows", f"""WITH {ctes_tfidf()},
{LAB},
{sql_folds(3, "0")}
SELECT t.doc_id, t.term_idx, {r6('t.value')} AS value FROM tfidf t
WHERE t.doc_id IN (SELECT doc_id FROM folds WHERE fold <> 0)""")
def q_fold_rows(spark, sf):
    """V4: the TF-IDF rows of the training part of validation fold 0 (semi join on the fold column)."""
    res = tf.tfidf(tb.records(spark, sf))
    folds = sp.stratified_folds(fx.labels_of(spark, sf), 3, 0)
    train = folds.filter(F.col("fold") != 0).select("doc_id")
    return res.matrix.join(train, "doc_id", "left_semi").select("doc_id", "term_idx", R("value").alias("value"))
