"""End-to-end jobs (P1-P4) built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screensift.operators import tfidf as tf
from screensift.sources import tables as tb


def top_terms_per_document(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Flagship slice: TF-IDF of the whole corpus, the k strongest terms per document."""
    res = tf.tfidf(tb.records(spark, sf_dir))
    w = Window.partitionBy("doc_id").orderBy(F.desc("value"), F.asc("term_idx"))
    top = res.matrix.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.join(F.broadcast(res.vocabulary.select("term_idx", "term")), "term_idx").select(
        "doc_id", "rank", "term", F.round("value", 6).alias("value"))


def classify_with_weights(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    """P3 with the closed-form linear model: score and label the unlabelled pool."""
    from screensift.operators import labels as lb
    from screensift.plans.features import centroid_scores

    s = centroid_scores(spark, sf_dir)
    unl = s.filter(F.col("label").isNull())
    return lb.threshold_predict(unl, threshold).select("doc_id", F.round("score", 6).alias("score"), "pred")


def threshold_report(scores: DataFrame, threshold: float) -> DataFrame:
    """P2 summary: distribution of per-fold AUC, recall and FPR at the chosen threshold."""
    from screensift.operators import cv
    from screensift.operators import metrics as M

    m = cv.cv_metrics_from_scores(scores, threshold).persist()  # a row a fold, read by every statistic
    long = m.select(F.explode(F.array(
        F.struct(F.lit("auc").alias("metric"), F.col("auc").alias("v")),
        F.struct(F.lit("recall").alias("metric"), F.col("recall").alias("v")),
        F.struct(F.lit("fpr").alias("metric"), F.col("fpr").alias("v")))).alias("m")).select("m.*")
    return M.summary(long, "v", ["metric"])


# ---- P1: find a model ---------------------------------------------------------------

from dataclasses import dataclass, field  # noqa: E402


@dataclass(frozen=True)
class FindModelOptions:
    model_name: str = "xgboost"
    search: "object" = None            # SearchOptions; defaults built from model_name
    stability_repeats: int = 100
    stability_folds: int = 3
    target_tpr: float = 1.0
    positive: str = "1"
    learning_curve_folds: int = 5
    learning_curve_proportions: tuple = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
    user_ranges: "object" = None       # DataFrame of range rows; replaces whole default entries (H1)
    lemmatize: bool = False            # T2: lemma table derived from the corpus by suffix rules
    resume_search: bool = False        # go on with the study left under out_dir instead of deleting it
    parallelism: int = 2
    tfidf: "object" = None             # TfidfOptions
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.stability_repeats < 1:
            raise ValueError("stability_repeats must be >= 1")


def find_model(spark: SparkSession, labelled: DataFrame, unlabelled: DataFrame, out_dir: str,
               opts: FindModelOptions = FindModelOptions()) -> dict[str, str]:
    """Features -> search -> OOF scores and reports -> stability -> refit -> SHAP -> artifacts."""
    from pyspark.ml import PipelineModel

    from screensift.operators import cv, explain as X, labels as lb, metrics as M, models as md
    from screensift.operators import search as H
    from screensift.operators.search_loop import SearchOptions, delete_study, run_search
    from screensift.sources import files as io

    topts = opts.tfidf or tf.TfidfOptions()
    lb.check_no_empty_rows(labelled)
    lb.check_no_empty_rows(unlabelled)
    labels = lb.binarize(labelled.select("doc_id", "label"), "label", opts.positive)
    corpus = tf.with_part(labelled, unlabelled)
    if corpus.select("doc_id").distinct().count() != corpus.count():
        raise ValueError("doc_id must be unique over the labelled and unlabelled records")
    lemmas = None
    if opts.lemmatize:
        from screensift.operators import text as tt
        lemmas = tt.lemma_table(tt.tokens(corpus.drop("part"), topts.null_token))
        io.write_parquet(lemmas, f"{out_dir}/lemmas")  # P3 needs the same table
        lemmas = spark.read.parquet(f"{out_dir}/lemmas")
    res = tf.tfidf(corpus.drop("part"), topts, lemmas)
    vec = md.vectorizer(res.vocabulary, topts)
    from screensift.operators.models import featurize
    feats = featurize(corpus.drop("part"), vec, topts, lemmas).persist()
    if feats.count() != corpus.count():
        raise ValueError("featurisation lost or repeated records")
    lab = feats.join(labels, "doc_id")
    unl = feats.join(unlabelled.select("doc_id"), "doc_id", "left_semi")
    sopts = opts.search or SearchOptions(model_name=opts.model_name)
    ranges = H.default_ranges(spark)
    # default kernels that Spark can fit; a kernel the user asks for is tried and fails with its reason
    fits = F.array_intersect("choices", F.array(*[F.lit(k) for k in md.SVC_KERNELS]))
    ranges = ranges.withColumn("choices", F.when(
        (F.col("model") == "SVC") & (F.col("param") == "kernel"), fits).otherwise(F.col("choices")))
    if opts.user_ranges is not None:
        ranges = H.merge_ranges(ranges, opts.user_ranges)
    if not opts.resume_search:
        delete_study(spark, f"{out_dir}/search", sopts.study)
    trials, scores = run_search(spark, lab, labels, ranges, sopts, f"{out_dir}/search")
    best = H.best_trial(trials.filter(F.col("state") == "COMPLETE").select("study", "trial", "objective"), trials)
    best_row = best.first()
    if best_row is None:
        raise RuntimeError(f"no trial of study {sopts.study!r} completed")
    params = {k: _num(v) for k, v in best_row["params"].items()}
    oof = cv.cv_scores(spark, lab, labels, opts.model_name, params, sopts.nfolds, 1, opts.parallelism)
    valid = oof.filter(F.col("split") == "valid")
    reports = {
        "roc": M.roc_curve(valid),
        "threshold": M.threshold_for_tpr(valid, [opts.target_tpr]),
        "score_histogram": M.histogram(valid, "score", 0.1, ["label"]),
        "fold_auc": M.roc_auc(valid, ["fold"]),
        "learning_curve": cv.learning_curve(spark, lab, labels, opts.model_name, params,
                                            opts.learning_curve_folds, opts.learning_curve_proportions,
                                            parallelism=opts.parallelism),
        "stability": cv.cv_metrics(spark, lab, labels, opts.model_name, params, opts.stability_folds,
                                   opts.stability_repeats, parallelism=opts.parallelism),
    }
    cw = lb.class_weight(labels).first()
    model, ignored = md.fit(lab, opts.model_name, params, n_rows=cw["n_pos"] + cw["n_neg"], weight=cw["weight"])
    if hasattr(model, "coefficients"):
        w = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(model.coefficients.toArray()) if v != 0],
                                  "term_idx int, weight double")
        shap = X.shap_linear(res.matrix, w, unl.select("doc_id"))
    else:
        vecs = tf.to_vector_arrays(res.matrix, unl.select("doc_id"))
        if isinstance(model, PipelineModel):  # Fourier map + linear SVC
            fmap, svc = model.stages
            d = fmap.getOrDefault(fmap.components)
            W, b = X.rff_matrix(spark, res.vocabulary.count(), fmap.getOrDefault(fmap.gamma), d)
            shap = X.shap_sampled_rff(spark, vecs, W, b, svc.coefficients.toArray(), svc.intercept)
        else:
            shap = X.shap_tree(spark, model, vecs)
    paths = io.write_artifacts(out_dir, res.vocabulary, res.matrix, labels, best, res.vectors)
    for k, df in reports.items():
        df.write.mode("errorifexists").parquet(f"{out_dir}/reports/{k}")
    shap.write.mode("errorifexists").parquet(f"{out_dir}/shap")
    io.save_model(PipelineModel(stages=list(vec.stages) + [model]), f"{out_dir}/model")
    feats.unpersist()
    res.unpersist()
    paths.update({"model": f"{out_dir}/model", "shap": f"{out_dir}/shap", "reports": f"{out_dir}/reports",
                  "ignored_params": ",".join(ignored)})
    return paths


def _num(v):
    from screensift.operators.search_loop import _parse
    return _parse(v)


# ---- P2 / P3 / P4 ---------------------------------------------------------------------

def analyse_threshold(spark: SparkSession, features: DataFrame, labels: DataFrame, model_name: str,
                      params: dict, threshold: float, nfolds: int = 3, repeats: int = 100,
                      parallelism: int = 2, confusion_repeats: int = 1) -> dict[str, DataFrame]:
    """Repeated-CV recall / FPR distributions, and train / validation confusion at a
    threshold over the first ``confusion_repeats`` repeats."""
    from screensift.operators import cv, metrics as M

    sc = cv.cv_scores(spark, features, labels, model_name, params, nfolds, repeats, parallelism)
    m = cv.cv_metrics_from_scores(sc, threshold)
    return {
        "metrics": m,
        "recall_histogram": M.histogram(m, "recall", 0.005),
        "fpr_histogram": M.histogram(m, "fpr", 0.005),
        "summary": threshold_report(sc, threshold),
        "confusion": M.confusion(sc.filter(F.col("repeat") < confusion_repeats), threshold, ["split"]),
    }


def classify(spark: SparkSession, records: DataFrame, model_path: str, threshold: float, out_path: str,
             opts=None, lemmas: DataFrame | None = None) -> DataFrame:
    """Score the unlabelled pool with a saved pipeline and write (doc_id, score, pred).

    ``lemmas`` is the table that P1 wrote beside a lemmatised model.
    """
    from screensift.operators import models as md
    from screensift.sources import files as io

    model = io.load_model(model_path)
    terms = md.with_terms(records, opts or tf.TfidfOptions(), lemmas)
    out = md.score(model, terms).withColumn("pred", (F.col("score") >= F.lit(float(threshold))).cast("int"))
    out = out.select("doc_id", "score", "pred")
    io.write_parquet(out, out_path)
    return spark.read.parquet(out_path)


def compare_models(spark: SparkSession, features: DataFrame, labels: DataFrame,
                   models: list[tuple[str, str, dict, float]], nfolds: int = 3, repeats: int = 1,
                   parallelism: int = 2) -> DataFrame:
    """Several (name, model, params, threshold) over the same folds -> per-model fold metrics."""
    from screensift.operators import cv

    parts, thr = [], []
    for name, model_name, params, t in models:
        s = cv.cv_scores(spark, features, labels, model_name, params, nfolds, repeats, parallelism)
        parts.append(s.filter(F.col("split") == "valid").withColumn("model", F.lit(name)))
        thr.append((name, float(t)))
    allsc = parts[0]
    for p in parts[1:]:
        allsc = allsc.unionByName(p)
    thresholds = spark.createDataFrame(thr, "model string, threshold double")
    return cv.cv_metrics_per_model(allsc, thresholds, ["model", "repeat", "fold"])
