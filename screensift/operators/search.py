"""Hyper-parameter search as tables.

Search state is two tables: trials (study, model, trial, ...) and trial scores
(study, trial, step, auc). Candidate drawing, dependency pruning, overlays,
objectives, best-so-far, pruning rules, stop rules and the reports are queries
over them, per study, so many studies are processed at once. Running order
statistics per study use the bucketed prefix scan, so one study holding a third
of all trials is still spread over many tasks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screensift.functions.hashing import uniform
from screensift.functions.prefix import default_buckets, prefix_scan, quantile_bucket

# --- fixed values: default search ranges per model -------------------------------------
# (model, param, suggest_type, low, high, log, value, choices)
DEFAULT_RANGES = [
    ("SVC", "degree", "int", 2, 7, False, None, None),
    ("SVC", "C", "float", 1e-3, 100000, True, None, None),
    ("SVC", "gamma", "float", 1e-7, 1000, True, None, None),
    ("SVC", "coef0", "float", 1e-7, 1000, True, None, None),
    ("SVC", "tol", "float", 1e-7, 1e-3, True, None, None),
    ("SVC", "cache_size", "singular", None, None, None, "1000", None),
    ("SVC", "shrinking", "singular", None, None, None, "true", None),
    ("SVC", "kernel", "categorical", None, None, None, None, ["linear", "rbf", "sigmoid"]),
    ("xgboost", "n_estimators", "int", 100, 1000, False, None, None),
    ("xgboost", "max_depth", "int", 1, 5, False, None, None),
    ("xgboost", "reg_lambda", "float", 1e-4, 100, True, None, None),
    ("xgboost", "reg_alpha", "float", 1e-4, 100, True, None, None),
    ("xgboost", "learning_rate", "float", 1e-2, 1, True, None, None),
    ("xgboost", "booster", "singular", None, None, None, "gbtree", None),
    ("xgboost", "tree_method", "singular", None, None, None, "approx", None),
    ("xgboost", "feature_selector", "singular", None, None, None, "cyclic", None),
    ("xgboost", "verbosity", "singular", None, None, None, "2", None),
    ("lightgbm", "max_depth", "int", 1, 60, False, None, None),
    ("lightgbm", "min_data_in_leaf", "int", 1, 30, False, None, None),
    ("lightgbm", "num_leaves", "int", 2, 70, False, None, None),
    ("lightgbm", "num_iterations", "int", 100, 2000, False, None, None),
    ("lightgbm", "learning_rate", "float", 0.1, 0.45, False, None, None),
    ("lightgbm", "min_gain_to_split", "float", 1e-8, 1, True, None, None),
    ("lightgbm", "min_sum_hessian_in_leaf", "float", 1e-8, 1e-2, True, None, None),
    ("lightgbm", "lambda_l1", "float", 1e-9, 1, True, None, None),
    ("lightgbm", "lambda_l2", "float", 1e-9, 1, True, None, None),
    ("lightgbm", "data_sample_strategy", "singular", None, None, None, "bagging", None),
    ("lightgbm", "boosting", "singular", None, None, None, "gbdt", None),
    ("lightgbm", "tree_learner", "singular", None, None, None, "serial", None),
    ("lightgbm", "use_quantized_grad", "singular", None, None, None, "false", None),
    ("lightgbm", "bagging_fraction", "singular", None, None, None, "1.0", None),
    ("lightgbm", "bin_construct_sample_cnt", "singular", None, None, None, "20000", None),
    ("lightgbm", "bagging_freq", "singular", None, None, None, "1", None),
    ("RandomForestClassifier", "n_estimators", "int", 100, 1000, False, None, None),
    ("RandomForestClassifier", "criterion", "singular", None, None, None, "gini", None),
    ("RandomForestClassifier", "max_depth", "singular", None, None, None, None, None),
    ("RandomForestClassifier", "max_features", "singular", None, None, None, "sqrt", None),
    ("RandomForestClassifier", "max_leaf_nodes", "singular", None, None, None, None, None),
    ("RandomForestClassifier", "bootstrap", "singular", None, None, None, "true", None),
    ("RandomForestClassifier", "max_samples", "singular", None, None, None, None, None),
    ("RandomForestClassifier", "monotonic_cst", "singular", None, None, None, None, None),
    ("RandomForestClassifier", "min_samples_split", "singular", None, None, None, "2", None),
    ("RandomForestClassifier", "min_samples_leaf", "singular", None, None, None, "1", None),
    ("RandomForestClassifier", "min_weight_fraction_leaf", "singular", None, None, None, "0", None),
    ("RandomForestClassifier", "min_impurity_decrease", "singular", None, None, None, "0", None),
    ("RandomForestClassifier", "ccp_alpha", "singular", None, None, None, "0", None),
]

# --- fixed values: conditional parameters (model, param, parent, allowed parent values) ---
DEPENDENCIES = [
    ("SVC", "degree", "kernel", ["poly"]),
    ("SVC", "coef0", "kernel", ["poly", "sigmoid"]),
    ("SVC", "gamma", "kernel", ["rbf", "poly", "sigmoid"]),
    ("xgboost", "learning_rate", "booster", ["gbtree", "dart", "gblinear"]),
    ("xgboost", "gamma", "booster", ["gbtree", "dart"]),
    ("xgboost", "max_depth", "booster", ["gbtree", "dart"]),
    ("xgboost", "min_child_weight", "booster", ["gbtree", "dart"]),
    ("xgboost", "subsample", "booster", ["gbtree", "dart"]),
    ("xgboost", "max_delta_step", "booster", ["gbtree", "dart"]),
    ("xgboost", "tree_method", "booster", ["gbtree", "dart"]),
    ("xgboost", "grow_plolicy", "booster", ["gbtree", "dart"]),
    ("xgboost", "grow_plolicy", "tree_method", ["hist", "approx", "auto"]),
    ("xgboost", "max_leaves", "booster", ["gbtree", "dart"]),
    ("xgboost", "max_leaves", "tree_method", ["hist", "approx", "auto"]),
    ("xgboost", "max_bin", "booster", ["gbtree", "dart"]),
    ("xgboost", "max_bin", "tree_method", ["hist", "approx", "auto"]),
    ("xgboost", "num_parallel_tree", "booster", ["gbtree", "dart"]),
    ("xgboost", "sample_type", "booster", ["dart"]),
    ("xgboost", "normalize_type", "booster", ["dart"]),
    ("xgboost", "rate_drop", "booster", ["dart"]),
    ("xgboost", "one_drop", "booster", ["dart"]),
    ("xgboost", "skip_drop", "booster", ["dart"]),
    ("xgboost", "updater", "booster", ["gblinear"]),
    ("xgboost", "feature_selector", "booster", ["gblinear"]),
    ("xgboost", "top_k", "booster", ["gblinear"]),
    ("xgboost", "top_k", "feature_selector", ["greedy", "thrifty"]),
    ("lightgbm", "bagging_freq", "data_sample_strategy", ["bagging"]),
    ("lightgbm", "bagging_fraction", "data_sample_strategy", ["bagging"]),
    ("lightgbm", "drop_rate", "boosting_type", ["dart"]),
    ("lightgbm", "max_drop", "boosting_type", ["dart"]),
    ("lightgbm", "skip_drop", "boosting_type", ["dart"]),
    ("lightgbm", "xgboost_dart_mode", "boosting_type", ["dart"]),
    ("lightgbm", "uniform_drop", "boosting_type", ["dart"]),
    ("lightgbm", "top_rate", "data_sample_strategy", ["goss"]),
    ("lightgbm", "other_rate", "data_sample_strategy", ["goss"]),
    ("lightgbm", "top_k", "tree_learner", ["voting"]),
    ("lightgbm", "num_grad_quant_bins", "use_quantized_grad", ["true"]),
    ("lightgbm", "quant_train_renew_leaf", "use_quantized_grad", ["true"]),
    ("lightgbm", "stochastic_rounding", "use_quantized_grad", ["true"]),
    ("RandomForestClassifier", "oob_score", "bootstrap", ["true"]),
    ("RandomForestClassifier", "max_samples", "bootstrap", ["true"]),
]

# --- fixed values: parameters every trial of a model gets (the suggested value wins) ----
# "@class_weight" is replaced by n_neg / n_pos of the labels.
FIXED_PARAMS = [
    ("lightgbm", "verbosity", "0"), ("lightgbm", "objective", "binary"),
    ("lightgbm", "scale_pos_weight", "@class_weight"), ("lightgbm", "n_jobs", "1"),
    ("lightgbm", "device", "cpu"), ("lightgbm", "force_col_wise", "false"),
    ("lightgbm", "force_row_wise", "false"),
    ("xgboost", "verbosity", "2"), ("xgboost", "objective", "binary:logistic"),
    ("xgboost", "eval_metric", "logloss"), ("xgboost", "scale_pos_weight", "@class_weight"),
    ("xgboost", "n_jobs", "1"), ("xgboost", "device", "cpu"),
    ("xgboost", "enable_categorical", "false"), ("xgboost", "validate_parameters", "true"),
    ("SVC", "class_weight", "@class_weight"), ("SVC", "probability", "false"), ("SVC", "verbose", "false"),
    ("SVC", "decision_function_shape", "ovr"), ("SVC", "break_ties", "false"),
    ("RandomForestClassifier", "verbose", "0"), ("RandomForestClassifier", "n_jobs", "1"),
    ("RandomForestClassifier", "class_weight", "@class_weight"),
    ("RandomForestClassifier", "warm_start", "false"),
]

RANGE_SCHEMA = ("model string, param string, suggest_type string, low double, high double, log boolean, "
                "value string, choices array<string>")

# stop-rule defaults
MIN_TRIALS_FOR_STAGNATION = 50


def default_ranges(spark: SparkSession) -> DataFrame:
    rows = [(m, p, t, None if lo is None else float(lo), None if hi is None else float(hi), lg, v, ch)
            for m, p, t, lo, hi, lg, v, ch in DEFAULT_RANGES]
    return spark.createDataFrame(rows, RANGE_SCHEMA)


def dependencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEPENDENCIES, "model string, param string, parent string, allowed array<string>")


def fixed_params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXED_PARAMS, "model string, param string, value string")


def ranges_from_json(spark: SparkSession, path: str, model: str) -> DataFrame:
    """S3: read a ranges document {param: {low, high, log, suggest_type} | {value} | {choices}}."""
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    spec = "map<string, struct<low: double, high: double, log: boolean, suggest_type: string, value: string, " \
           "choices: array<string>>>"
    parsed = raw.select(F.explode(F.from_json("value", spec)).alias("param", "r"))
    return parsed.select(F.lit(model).alias("model"), "param", F.col("r.suggest_type").alias("suggest_type"),
                         F.col("r.low").alias("low"), F.col("r.high").alias("high"), F.col("r.log").alias("log"),
                         F.lower(F.col("r.value")).alias("value"), F.col("r.choices").alias("choices"))


def merge_ranges(defaults: DataFrame, user: DataFrame) -> DataFrame:
    """H1: user entries replace whole default entries per (model, param)."""
    cols = ["suggest_type", "low", "high", "log", "value", "choices"]
    u = user.select("model", "param", *[F.col(c).alias(f"u_{c}") for c in cols], F.lit(True).alias("_u"))
    j = defaults.join(u, ["model", "param"], "full")
    return j.select("model", "param", *[F.when(F.col("_u"), F.col(f"u_{c}")).otherwise(F.col(c)).alias(c)
                                        for c in cols])


def draw_value(u: Column) -> tuple[Column, Column]:
    """H2 draw from a range row: (value_num DOUBLE, value_str STRING)."""
    lo, hi, lg, st = F.col("low"), F.col("high"), F.col("log"), F.col("suggest_type")
    lin_f = lo + u * (hi - lo)
    log_f = F.exp(F.log(lo) + u * (F.log(hi) - F.log(lo)))
    lin_i = lo + F.floor(u * (hi - lo + 1))
    log_i = F.least(hi, F.floor(F.exp(F.log(lo) + u * (F.log(hi + 1) - F.log(lo)))))
    num = (F.when(st == "float", F.when(lg, log_f).otherwise(lin_f))
           .when(st == "int", F.when(lg, log_i).otherwise(lin_i)).cast("double"))
    cat = F.element_at(F.col("choices"), (F.floor(u * F.size("choices")) + 1).cast("int"))
    s = F.when(st == "categorical", cat).when(st == "singular", F.col("value"))
    return num, s


def draw_candidates(trials: DataFrame, ranges: DataFrame) -> DataFrame:
    """H2: (study, model, trial, param, suggest_type, value_num, value_str) for every range row.

    The range table is a few dozen rows per model (bounded), so it is broadcast.
    """
    j = trials.select("study", "model", "trial").join(F.broadcast(ranges), "model")
    u = uniform(F.col("study"), F.col("trial"), F.col("param"))
    num, s = draw_value(u)
    return j.select("study", "model", "trial", "param", "suggest_type", num.alias("value_num"),
                    s.alias("value_str"))


def _value_text(num: Column, s: Column) -> Column:
    whole = F.when(F.col("suggest_type") == "int", num.cast("bigint").cast("string"))
    return F.coalesce(s, whole, num.cast("string"))


def chain_depth(pairs: Sequence[tuple]) -> int:
    """Longest dependency chain of (model, param, parent) rows; raises on a cycle."""
    level: dict[tuple, int] = {}
    for _ in range(len(pairs) + 1):
        raised = False
        for model, param, parent in pairs:
            need = level.get((model, parent), 0) + 1
            if level.get((model, param), 0) < need:
                level[(model, param)], raised = need, True
        if not raised:
            return max(level.values(), default=0)
    raise ValueError("parameter dependencies form a cycle")


def active_params(candidates: DataFrame, deps: DataFrame) -> DataFrame:
    """H3: keep a parameter only if every parent is kept and holds an allowed value.

    A parent that is absent drops the child. As many passes as the longest
    dependency chain reach the fixpoint; a cycle is an error.
    """
    d = F.broadcast(deps)  # bounded: fixed list per model
    active = candidates
    pairs = [(r.model, r.param, r.parent) for r in deps.select("model", "param", "parent").collect()]
    for _ in range(chain_depth(pairs)):
        parents = active.select("study", "trial", F.col("param").alias("parent"),
                                F.col("value_str").alias("parent_value"))
        req = active.select("study", "model", "trial", "param").join(d, ["model", "param"])
        ok = req.join(parents, ["study", "trial", "parent"], "left").withColumn(
            "ok", F.coalesce(F.array_contains("allowed", F.col("parent_value")), F.lit(False)))
        bad = ok.filter(~F.col("ok")).select("study", "trial", "param").distinct()
        active = active.join(bad, ["study", "trial", "param"], "left_anti")
    return active


def trial_params(active: DataFrame, fixed: DataFrame, class_weight: Column) -> DataFrame:
    """H4: (study, trial, param, value, source): fixed overlay, suggested value wins."""
    trials = active.select("study", "model", "trial").distinct()
    fx = trials.join(F.broadcast(fixed), "model").select(
        "study", "trial", "param",
        F.when(F.col("value") == "@class_weight", class_weight.cast("string")).otherwise(F.col("value")).alias(
            "value"), F.lit("fixed").alias("source"), F.lit(1).alias("prio"))
    sg = active.select("study", "trial", "param", _value_text(F.col("value_num"), F.col("value_str")).alias("value"),
                       F.lit("suggested").alias("source"), F.lit(0).alias("prio"))
    both = fx.unionByName(sg)
    best = both.groupBy("study", "trial", "param").agg(F.min_by(F.struct("value", "source"), "prio").alias("b"))
    return best.select("study", "trial", "param", F.col("b.value").alias("value"), F.col("b.source").alias("source"))


def params_map(tp: DataFrame) -> DataFrame:
    """Trial parameters as MAP<STRING,STRING> (the trial table's params column)."""
    return tp.groupBy("study", "trial").agg(F.map_from_entries(F.collect_list(F.struct("param", "value"))).alias(
        "params"))


def trial_objective(scores: DataFrame) -> DataFrame:
    """H5: objective = mean step AUC (rounded to 9 places so equal means compare equal)."""
    return scores.groupBy("study", "trial").agg(
        F.round(F.avg("auc"), 9).alias("objective"), F.count(F.lit(1)).alias("n_steps"))


def _scan_trials(obj: DataFrame) -> DataFrame:
    """Running best per study in trial order: (objective, -trial) maximum."""
    x = obj.withColumn("_key", F.struct(F.col("objective"), (-F.col("trial")).alias("neg_trial")))
    nb = default_buckets(x)
    x = quantile_bucket(x, "trial", nb, by=["study"])(x)
    x = x.withColumn("_z", F.lit(0))
    out = prefix_scan(x, ["study"], "_bk", F.col("trial"), ["_z"], maxes=["_key"])
    return out.drop("_bk", "_z", "_z_cum", "_z_total")


def best_so_far(obj: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """H6: for each trial, the best COMPLETE trial strictly before it (NULL if none)."""
    x = obj if state is None else obj.join(state, ["study", "trial"])
    if "state" in x.columns:
        x = x.withColumn("objective", F.when(F.col("state") == "COMPLETE", F.col("objective")))
    s = _scan_trials(x)
    prev = F.col("_key_cummax_prev")
    return s.select("study", "trial", "objective",
                    F.when(prev["objective"].isNotNull(), -prev["neg_trial"]).cast("int").alias("best_trial"),
                    prev["objective"].alias("best_objective"))


def search_history(obj: DataFrame) -> DataFrame:
    """Objective and best value so far (inclusive) per trial."""
    s = _scan_trials(obj)
    return s.select("study", "trial", "objective", F.col("_key_cummax")["objective"].alias("best_value"))


def prune_first_two(scores: DataFrame, best: DataFrame) -> DataFrame:
    """H7: prune after the first step if it is below both of the best trial's first two steps.

    Before any completed trial the best vector is all zeros (never prunes).
    """
    s0 = scores.filter(F.col("step") == 0).select("study", "trial", F.col("auc").alias("s0"))
    b = best.select("study", "trial", "best_trial")
    bests = b.select("study", F.col("best_trial").alias("trial")).distinct()
    bs = scores.filter(F.col("step") <= 1).join(bests, ["study", "trial"], "left_semi").groupBy("study", "trial").agg(
        F.max(F.when(F.col("step") == 0, F.col("auc"))).alias("b0"),
        F.max(F.when(F.col("step") == 1, F.col("auc"))).alias("b1")).withColumnRenamed("trial", "best_trial")
    j = s0.join(b, ["study", "trial"]).join(bs, ["study", "best_trial"], "left")
    b0, b1 = F.coalesce("b0", F.lit(0.0)), F.coalesce("b1", F.lit(0.0))
    return j.select("study", "trial", ((F.col("s0") < b0) & (F.col("s0") < b1)).alias("prune"))


def wilcoxon_stats(scores: DataFrame, best: DataFrame) -> DataFrame:
    """H8 statistic: zero-split signed ranks of d = trial step - best step, per trial.

    (study, trial, n, r_plus, r_minus, tie_term, has_ties_or_zeros, mean_diff).
    Groups are one trial's steps (bounded by folds x repeats).
    """
    b = best.filter(F.col("best_trial").isNotNull() & (F.col("trial") >= 2)).select("study", "trial", "best_trial")
    mine = scores.join(b, ["study", "trial"])
    bests = b.select("study", "best_trial").distinct()
    theirs = scores.select("study", F.col("trial").alias("best_trial"), "step", F.col("auc").alias("best_auc")).join(
        bests, ["study", "best_trial"], "left_semi")
    # many trials can share one best trial (a hot key): AQE's skew join splits that side
    d = mine.join(theirs, ["study", "best_trial", "step"]).withColumn("d", F.col("auc") - F.col("best_auc"))
    d = d.withColumn("a", F.abs("d"))
    w = Window.partitionBy("study", "trial").orderBy("a")
    wt = Window.partitionBy("study", "trial", "a")
    d = d.withColumn("rk", F.rank().over(w)).withColumn("t", F.count(F.lit(1)).over(wt))
    d = d.withColumn("r", F.col("rk") + (F.col("t") - 1) / 2.0)
    g = d.groupBy("study", "trial").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("d") > 0, F.col("r")).when(F.col("d") == 0, F.col("r") / 2.0).otherwise(0.0)).alias(
            "r_plus"),
        F.sum(F.when(F.col("d") < 0, F.col("r")).when(F.col("d") == 0, F.col("r") / 2.0).otherwise(0.0)).alias(
            "r_minus"),
        # sum over tie groups of t^3 - t, written per member as t^2 - 1
        F.sum(F.col("t").cast("double") * F.col("t") - 1.0).alias("_tt"),
        F.max((F.col("t") > 1) | (F.col("d") == 0)).alias("has_ties_or_zeros"),
        F.avg("d").alias("mean_diff"))
    return g


@lru_cache(maxsize=64)
def _signed_rank_cdf(n: int) -> tuple:
    """Exact null distribution of the signed-rank sum for n untied, non-zero differences."""
    m = n * (n + 1) // 2
    counts = [0] * (m + 1)
    counts[0] = 1
    for k in range(1, n + 1):
        for s in range(m, k - 1, -1):
            counts[s] += counts[s - k]
    total = float(2 ** n)
    cdf, acc = [], 0
    for c in counts:
        acc += c
        cdf.append(acc / total)
    return tuple(cdf)


def signed_rank_p_less(n: int, r_plus: float, tie_term: float, exact: bool) -> float:
    """One-sided p-value P(T <= r_plus) for the 'less' alternative."""
    if n <= 0:
        return float("nan")
    if exact:
        cdf = _signed_rank_cdf(n)
        k = int(math.floor(r_plus + 1e-9))
        return cdf[max(0, min(k, len(cdf) - 1))] if k >= 0 else 0.0
    mn = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - tie_term / 48.0
    if var <= 0:
        return float("nan")
    z = (r_plus - mn) / math.sqrt(var)
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def wilcoxon_p_less(n: pd.Series, r_plus: pd.Series, tie_term: pd.Series, exact: pd.Series) -> pd.Series:
    """Arrow-batched p-values (exact table for small n, normal approximation otherwise)."""
    return pd.Series([signed_rank_p_less(int(a), float(b), float(c), bool(d))
                      for a, b, c, d in zip(n, r_plus, tie_term, exact)], dtype="float64")


def prune_wilcoxon(stats: DataFrame, threshold: float = 0.1, exact_max_n: int = 50) -> DataFrame:
    """H8 decision: prune when p < threshold, unless the trial's mean is not below the best's."""
    exact = (F.col("n") <= exact_max_n) & ~F.col("has_ties_or_zeros")
    p = wilcoxon_p_less(F.col("n"), F.col("r_plus"), F.col("_tt"), exact)
    x = stats.withColumn("p_value", p)
    average_is_best = F.col("mean_diff") >= 0
    return x.select("study", "trial", "n", "r_plus", "p_value",
                    ((F.col("p_value") < threshold) & ~average_is_best).alias("prune"))


def prune_decision(first_two: DataFrame, wilcoxon: DataFrame) -> DataFrame:
    """H9: either pruner decides."""
    j = first_two.join(wilcoxon.select("study", "trial", F.col("prune").alias("w")), ["study", "trial"], "left")
    return j.select("study", "trial", (F.col("prune") | F.coalesce("w", F.lit(False))).alias("prune"))


def stop_rules(trials: DataFrame, obj: DataFrame, max_trials: int | None, max_stagnation: int | None,
               timeout_s: float | None) -> DataFrame:
    """(study, rule, stop_trial) -- first trial at which each stop rule fires."""
    out = []
    if max_trials is not None and max_trials > 0:
        counted = trials.filter(F.col("state").isin("COMPLETE", "PRUNED"))
        nb = default_buckets(counted)
        c = quantile_bucket(counted, "trial", nb, by=["study"])(counted).withColumn("_one", F.lit(1))
        r = prefix_scan(c, ["study"], "_bk", F.col("trial"), ["_one"])
        out.append(r.filter(F.col("_one_cum") == max_trials).select(
            "study", F.lit("max_trials").alias("rule"), F.col("trial").alias("stop_trial")))
    if max_stagnation is not None and max_stagnation > 0:
        s = _scan_trials(obj.join(trials.filter(F.col("state") == "COMPLETE").select("study", "trial"),
                                  ["study", "trial"]))
        best_t = -F.col("_key_cummax")["neg_trial"]
        fire = (F.col("_idx") >= MIN_TRIALS_FOR_STAGNATION) & (F.col("trial") - best_t >= max_stagnation)
        out.append(s.filter(fire).groupBy("study").agg(F.min("trial").alias("stop_trial")).select(
            "study", F.lit("stagnation").alias("rule"), "stop_trial"))
    if timeout_s is not None and timeout_s > 0:
        start = trials.groupBy("study").agg(F.min("started").alias("t0"))
        t = trials.join(start, "study").filter(F.col("finished") - F.col("t0") >= timeout_s)
        out.append(t.groupBy("study").agg(F.min("trial").alias("stop_trial")).select(
            "study", F.lit("timeout").alias("rule"), "stop_trial"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.select("study", "rule", F.col("stop_trial").cast("int").alias("stop_trial"))


def best_trial(obj: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Best trial per study (highest objective, lowest trial on ties), with its
    ``params`` map when a (study, trial, params) table is given."""
    b = obj.groupBy("study").agg(F.max(F.struct(F.col("objective"), (-F.col("trial")).alias("nt"))).alias("b"))
    b = b.select("study", (-F.col("b.nt")).cast("int").alias("trial"), F.col("b.objective").alias("objective"))
    return b if params is None else b.join(params.select("study", "trial", "params"), ["study", "trial"])


def studies(trials: DataFrame, obj: DataFrame) -> DataFrame:
    """H12 listing: trials per study and state, best objective."""
    t = trials.groupBy("study").agg(F.count(F.lit(1)).alias("n_trials"),
                                    F.count_if(F.col("state") == "COMPLETE").alias("n_complete"),
                                    F.count_if(F.col("state") == "PRUNED").alias("n_pruned"))
    return t.join(obj.groupBy("study").agg(F.max("objective").alias("best_objective")), "study", "left")


def delete_study(trials: DataFrame, name: str) -> DataFrame:
    """H12 delete: the trial table without one study (write back with overwrite)."""
    return trials.filter(F.col("study") != name)


def range_position(num: Column) -> Column:
    """Position of a drawn value in its sampling space, in [0, 1]."""
    lo, hi = F.col("low"), F.col("high")
    lin = (num - lo) / (hi - lo)
    lg = (F.log(num) - F.log(lo)) / (F.log(hi) - F.log(lo))
    return F.when(hi > lo, F.when(F.col("log"), lg).otherwise(lin))


def param_importance(candidates: DataFrame, ranges: DataFrame, obj: DataFrame, bins: int = 10) -> DataFrame:
    """Share of objective variance explained by the binned parameter (between / total).

    Bins are equal-width in the sampling space, so no ranking window is needed.
    """
    c = candidates.filter(F.col("value_num").isNotNull()).join(
        F.broadcast(ranges.select("model", "param", "low", "high", "log")), ["model", "param"])
    c = c.withColumn("bin", F.least(F.lit(bins - 1), F.floor(range_position(F.col("value_num")) * bins)))
    j = c.join(obj, ["study", "trial"])
    tot = j.groupBy("study", "param").agg(F.avg("objective").alias("mu"), F.var_pop("objective").alias("var"),
                                          F.count(F.lit(1)).alias("n"))
    grp = j.groupBy("study", "param", "bin").agg(F.avg("objective").alias("mb"), F.count(F.lit(1)).alias("nb"))
    g = grp.join(tot, ["study", "param"])
    between = g.groupBy("study", "param").agg(
        (F.sum(F.col("nb") * (F.col("mb") - F.col("mu")) * (F.col("mb") - F.col("mu"))) / F.first("n")).alias("bv"),
        F.first("var").alias("var"))
    return between.select("study", "param", F.when(F.col("var") > 0, F.col("bv") / F.col("var")).otherwise(
        0.0).alias("importance"))


def search_timeline(trials: DataFrame) -> DataFrame:
    """Per trial: start, end, duration and state (epoch seconds)."""
    return trials.select("study", "trial", "state", "started", "finished",
                         (F.col("finished") - F.col("started")).alias("duration_s"))


def search_slice(candidates: DataFrame, obj: DataFrame) -> DataFrame:
    """(study, param, trial, value, objective, colour_rank) with colour = int(average rank) - 1.

    Average ranks come from counts of distinct objectives and a prefix scan,
    never from a whole-study window.
    """
    dc = obj.groupBy("study", "objective").agg(F.count(F.lit(1)).alias("c"))
    nb = default_buckets(dc)
    dc = quantile_bucket(dc, "objective", nb, by=["study"])(dc)
    r = prefix_scan(dc, ["study"], "_bk", F.col("objective"), ["c"])
    avg_rank = (F.col("c_cum") - F.col("c") + 1) + (F.col("c") - 1) / 2.0
    ranks = r.select("study", "objective", (F.floor(avg_rank) - 1).cast("int").alias("colour_rank"))
    o = obj.join(ranks, ["study", "objective"])
    return candidates.filter(F.col("value_num").isNotNull() | F.col("value_str").isNotNull()).join(
        o, ["study", "trial"]).select("study", "param", "trial", "value_num", "value_str", "objective",
                                      "colour_rank")


def objective_quantiles(obj: DataFrame) -> DataFrame:
    """0/25/50/75/100 % quantiles of the objective per study (linear interpolation)."""
    from screensift.operators.metrics import exact_quantiles

    q = exact_quantiles(obj, "objective", [0.0, 0.25, 0.5, 0.75, 1.0], ["study"])
    return q.select("study", F.col("p").alias("quantile"), F.col("q").alias("value"))


def ranges_to_json(ranges: DataFrame, model: str) -> str:
    """Inverse of ranges_from_json for one model (a small, bounded table)."""
    out = {}
    for r in ranges.filter(F.col("model") == model).collect():
        if r["suggest_type"] == "singular":
            out[r["param"]] = {"suggest_type": "singular", "value": r["value"]}
        elif r["suggest_type"] == "categorical":
            out[r["param"]] = {"suggest_type": "categorical", "choices": list(r["choices"])}
        else:
            out[r["param"]] = {"suggest_type": r["suggest_type"], "low": r["low"], "high": r["high"],
                               "log": bool(r["log"])}
    return json.dumps(out)

