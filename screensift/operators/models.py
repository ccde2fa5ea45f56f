"""Spark ML estimator factory, feature vectors, scoring, linear scorer.

The fitted TF-IDF state becomes a Spark ML PipelineModel
(CountVectorizerModel over the vocabulary in term_idx order -> idf scaling ->
L2 Normalizer). Transforming new documents is then a narrow, per-row JVM step
with no join or shuffle; its output equals the long-form TF-IDF table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.functions import text as tx
from screensift.functions.fourier import FourierMap, fourier_array
from screensift.operators import tfidf as tf
from screensift.operators.boosting import NAMES, Boosting, growth
from screensift.operators.tfidf import vectorizer  # noqa: F401

MAX_TREE_DEPTH = 30  # Spark ML limit
MAX_SVC_ITERATIONS = 1000  # for an SVC asked to run without a limit
SVC_KERNELS = ("linear", "rbf")
#: Parameters of a kernel besides gamma.
KERNEL_PARAMS: dict[str, tuple] = {}

class UnknownModel(ValueError):
    """A job asks for a model that no builder serves."""


# ---- features --------------------------------------------------------------------

def with_terms(records: DataFrame, opts: tf.TfidfOptions = tf.TfidfOptions(),
               lemmas: DataFrame | None = None) -> DataFrame:
    """(doc_id, terms ARRAY): every n-gram occurrence of each document, in-row.

    ``lemmas`` must be the table the vocabulary was fitted with, if any.
    """
    w = tf.words(records, opts, lemmas)
    return w.select("doc_id", tx.ngram_col(F.col("words"), opts.ngram_min, opts.ngram_max).alias("terms"))


def featurize(records: DataFrame, model: PipelineModel, opts: tf.TfidfOptions = tf.TfidfOptions(),
              lemmas: DataFrame | None = None) -> DataFrame:
    """(doc_id, features VECTOR) for any records; narrow unless words are lemmatised."""
    return model.transform(with_terms(records, opts, lemmas)).select("doc_id", "features")


# ---- estimator factory ---------------------------------------------------------------

@dataclass
class ModelSpec:
    name: str
    params: dict = field(default_factory=dict)
    ignored: tuple = ()


def _num(params: Mapping, key: str, default):
    v = params.get(key, default)
    return default if v is None else v


def effective_params(model_name: str, params: Mapping | None) -> dict:
    """The parameters as Spark ML will use them; trial tables record these.

    Depths beyond the library's limit, and no limit at all (0, negative, NULL for a
    forest), become the limit; an SVC without an iteration limit gets MAX_SVC_ITERATIONS.
    """
    p = dict(params or {})
    if model_name in ("lightgbm", "xgboost") and p.get("max_depth") is not None:
        depth = int(p["max_depth"])
        p["max_depth"] = depth if 0 < depth <= MAX_TREE_DEPTH else MAX_TREE_DEPTH
    if model_name == "RandomForestClassifier":
        depth = p.get("max_depth")
        p["max_depth"] = MAX_TREE_DEPTH if depth is None else min(MAX_TREE_DEPTH, int(depth))
    if model_name == "SVC" and p.get("max_iter") is not None and int(p["max_iter"]) <= 0:
        p["max_iter"] = MAX_SVC_ITERATIONS
    return p


class _Parameters:
    """Parameters of one model; remembers which of them were read."""

    def __init__(self, model_name: str, params: Mapping | None, weight_sum: float | None, positive: float):
        self.values, self.weight_sum, self.positive = effective_params(model_name, params), weight_sum, positive
        self.read: set[str] = set()

    def take(self, key: str, default):
        self.read.add(key)
        return _num(self.values, key, default)

    @property
    def ignored(self) -> tuple:
        return tuple(sorted(k for k in self.values if k not in self.read))


def _boosted(name: str, p: _Parameters, common: dict):
    p.read |= set(NAMES[name]) | {"scale_pos_weight"}  # positives weigh what the fit is told
    return Boosting(growth(name, p.values), p.positive, common["labelCol"])


def linear_penalties(params: Mapping) -> tuple[float, float, int]:
    """(L2, L1, rounds) of the linear booster; both libraries add the penalty to the weighted mean loss."""
    return float(_num(params, "reg_lambda", 0.0)), float(_num(params, "reg_alpha", 0.0)), int(_num(params, "n_estimators", 100))


def _linear_booster(p: _Parameters, common: dict):
    lam, alpha, rounds = linear_penalties(p.values)
    p.read |= {"reg_lambda", "reg_alpha", "n_estimators"}
    return LogisticRegression(regParam=lam + alpha, elasticNetParam=(alpha / (lam + alpha)) if lam + alpha > 0 else 0.0,
                              maxIter=rounds, standardization=False, **common)


def _xgboost(p: _Parameters, common: dict):
    booster = p.take("booster", "gbtree")
    if booster == "gbtree":
        return _boosted("xgboost", p, common)
    if booster == "gblinear":
        return _linear_booster(p, common)
    raise ValueError("dart booster is not supported" if booster == "dart" else f"unknown booster {booster}")


def _lightgbm(p: _Parameters, common: dict):
    if p.take("boosting", "gbdt") != "gbdt":
        raise ValueError("only gbdt boosting is supported")
    return _boosted("lightgbm", p, common)


def _random_forest(p: _Parameters, common: dict):
    return RandomForestClassifier(
        numTrees=int(p.take("n_estimators", 100)), maxDepth=int(p.take("max_depth", MAX_TREE_DEPTH)),
        featureSubsetStrategy=str(p.take("max_features", "sqrt")), impurity=str(p.take("criterion", "gini")),
        minInstancesPerNode=int(p.take("min_samples_leaf", 1)), bootstrap=bool(p.take("bootstrap", True)),
        seed=int(p.take("random_state", 0) or 0), **common)


def _svc(p: _Parameters, common: dict):
    kernel = p.take("kernel", "linear")
    if kernel not in SVC_KERNELS:
        raise ValueError(f"SVC kernel {kernel!r} is not supported on Spark ({', '.join(SVC_KERNELS)} only)")
    p.read |= {"gamma", *KERNEL_PARAMS.get(kernel, ())}
    return LinearSVC(regParam=1.0 / (float(p.take("C", 1.0)) * float(p.weight_sum or 1)), tol=float(p.take("tol", 1e-3)),
                     maxIter=int(p.take("max_iter", 100)), standardization=False, **common)


#: Model name a job may ask for -> what builds its estimator from the parameters.
BUILDERS = {"xgboost": _xgboost, "lightgbm": _lightgbm, "RandomForestClassifier": _random_forest, "SVC": _svc}


def make_estimator(model_name: str, params: Mapping | None = None, weight_sum: float | None = None,
                   weight_col: str | None = "weight", features_col: str = "features",
                   label_col: str = "label_d", positive: float = 1.0):
    """M1: model name + reference-style parameters -> estimator.

    Returns (estimator, ignored parameter names). Parameters without a
    counterpart are reported, not silently dropped. ``weight_sum`` is the sum of
    the training rows' weights: the SVC's C multiplies a sum of losses, Spark's
    penalty goes with their weighted mean. Boosted trees weigh positives by
    ``positive``, Spark's estimators read ``weight_col``.
    """
    builder = BUILDERS.get(model_name)
    if builder is None:
        raise UnknownModel(f"no estimator for {model_name!r}; known: {', '.join(sorted(BUILDERS))}")
    p = _Parameters(model_name, params, weight_sum, positive)
    common = dict(featuresCol=features_col, labelCol=label_col)
    if weight_col:
        common["weightCol"] = weight_col
    est = builder(p, common)
    return est, p.ignored


def rff_features(matrix: DataFrame, docs: DataFrame, gamma: float, n_components: int = 128,
                 seed: int = 0, vectors: DataFrame | None = None) -> DataFrame:
    """M7 (rbf): random Fourier features z = sqrt(2/D) cos(x W + b), W ~ N(0, 2 gamma).

    One row per document in, one out; W and b are drawn in the tasks (functions/fourier.py).
    ``vectors``, where given, are the rows of ``matrix`` and move in its place.
    """
    ids = docs.select("doc_id")
    rows = tf.to_vector_arrays(matrix, ids) if vectors is None else tf.document_arrays(vectors, ids)
    z = fourier_array(F.col("indices"), F.col("values"), gamma, n_components, seed)
    return rows.select("doc_id", array_to_vector(z).alias("features"))


def fit(train: DataFrame, model_name: str, params: Mapping | None = None, n_rows: int | None = None,
        weight: float | None = None):
    """Fit on ``n_rows`` rows of (doc_id, features, label); ``weight``, the positives', is n_neg / n_pos.

    Returns (fitted model, ignored parameter names). An rbf SVC is a linear one over
    random Fourier features: a PipelineModel of the map and the linear model.
    ``gamma`` defaults to 1 (TF-IDF rows have unit length).
    """
    df = train.withColumn("label_d", F.col("label").cast("double"))
    wcol, weight_sum = None, n_rows
    if weight is not None:
        # n_neg + weight * n_pos = 2 n_neg, and n_neg = n weight / (1 + weight)
        weight_sum = 2.0 * n_rows * weight / (1.0 + weight) if n_rows else None
        df = df.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
        wcol = "weight"
    if model_name == "SVC" and _num(params or {}, "kernel", "linear") == "rbf":
        fmap = FourierMap(gamma=float(_num(params, "gamma", 1.0)))
        est, ignored = make_estimator(model_name, params, weight_sum, weight_col=wcol,
                                      features_col=fmap.getOutputCol())
        return PipelineModel(stages=[fmap, est.fit(fmap.transform(df))]), ignored
    est, ignored = make_estimator(model_name, params, weight_sum, weight_col=wcol, positive=1.0 if weight is None else float(weight))
    return est.fit(df), ignored


def score(model, df: DataFrame) -> DataFrame:
    """M8: raw score per row: positive margin, or positive-class probability for forests."""
    out = model.transform(df)
    name = type(model).__name__
    col = "probability" if name.startswith("RandomForest") else "rawPrediction"
    keep = [c for c in df.columns if c != "features"]
    return out.select(*keep, vector_to_array(F.col(col))[1].alias("score"))


def raw_threshold_predict(model, df: DataFrame, threshold: float) -> DataFrame:
    """Scores and 0/1 prediction at a raw threshold."""
    return score(model, df).withColumn("pred", (F.col("score") >= F.lit(float(threshold))).cast("int"))


# ---- linear scorer (SQL-reproducible) ----------------------------------------------

def linear_score(matrix: DataFrame, weights: DataFrame, docs: DataFrame, intercept: float | Column = 0.0,
                 groups: tuple = ()) -> DataFrame:
    """M9: score = intercept + sum(value * weight); documents without terms score the intercept.

    Without groups, ``weights`` (term_idx, weight) is bounded by the vocabulary
    and broadcast. With groups, ``docs`` carries the group columns and rows
    meet their own group's weights on (groups..., term_idx).
    """
    g = list(groups)
    b = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    if g:
        rows = docs.select(*g, "doc_id").join(matrix, "doc_id").join(weights, g + ["term_idx"])
    else:
        rows = matrix.join(F.broadcast(weights), "term_idx")
    s = rows.groupBy(*g, "doc_id").agg(F.sum(F.col("value") * F.col("weight")).alias("_s"))
    return docs.join(s, g + ["doc_id"], "left").withColumn(
        "score", F.coalesce(F.col("_s"), F.lit(0.0)) + b).drop("_s")


def centroid_weights(matrix: DataFrame, labels: DataFrame, groups: tuple = (), vectors: DataFrame | None = None) -> DataFrame:
    """Weights = mean TF-IDF over positive documents - mean over negatives (zeros included).

    A closed-form linear model used where results must be checkable in SQL.
    ``labels`` is (groups..., doc_id, label); the class-count table has one row
    per group and is broadcast. ``vectors``, where given, are the rows of ``matrix``:
    they meet the labels before entries are made of them.
    """
    g = list(groups)
    if not g:
        labels, g = labels.withColumn("_g", F.lit(0)), ["_g"]
    n = labels.groupBy(*g).agg(F.count_if(F.col("label") == 1).alias("n_pos"),
                               F.count_if(F.col("label") == 0).alias("n_neg"))
    rows = matrix.join(labels, "doc_id") if vectors is None else tf.vector_entries(vectors.join(labels, "doc_id"), *g, "label")
    sums = rows.groupBy(*g, "term_idx").agg(
        F.sum(F.when(F.col("label") == 1, F.col("value")).otherwise(0.0)).alias("sp"),
        F.sum(F.when(F.col("label") == 0, F.col("value")).otherwise(0.0)).alias("sn"))
    j = sums.join(F.broadcast(n), g)
    w = F.coalesce(F.try_divide("sp", "n_pos"), F.lit(0.0)) - F.coalesce(F.try_divide("sn", "n_neg"), F.lit(0.0))
    out_g = [c for c in g if c != "_g"]
    return j.select(*out_g, "term_idx", w.alias("weight"))
