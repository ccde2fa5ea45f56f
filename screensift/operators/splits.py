"""Stratified (repeated) folds, stratified hold-out and learning-curve subsets.

Row order inside a class is md5(seed-doc_id) (then doc_id), so membership is a
pure function of (seed, doc_id) and identical in any engine. Ranks inside a
class come from the bucketed prefix scan (hash prefix buckets), never from a
single-partition window. Per-class targets are computed on a table with one
row per class, which is bounded by the number of classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screensift.functions.hashing import seeded_hash
from screensift.functions.prefix import default_buckets, global_rank, hex_bucket

LEARNING_PROPORTIONS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
MIN_CLASS_FOR_SMALL_PROPORTIONS = 13


def _rank_in_class(df: DataFrame, seed: Column, partition_by: Sequence[str]) -> DataFrame:
    h = seeded_hash(seed, F.col("doc_id"))
    x = df.withColumn("_h", h)
    r = global_rank(x, list(partition_by), F.struct(F.col("_h"), F.col("doc_id")),
                    hex_bucket(F.col("_h"), default_buckets(x)))
    return r.withColumnRenamed("_idx", "rank_in_class").drop("_h", "_n")


def _class_offsets(counts: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    w = (Window.partitionBy(*partition_by) if partition_by else Window).orderBy("label")
    return counts.withColumn(
        "class_offset", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def stratified_folds(labels: DataFrame, k: int = 5, seed: int = 0) -> DataFrame:
    """(doc_id, label, fold); fold = (class_offset + rank_in_class - 1) % k."""
    if k < 2:
        raise ValueError("need at least 2 folds")
    return repeated_folds(labels, k, repeats=None, seed=seed).drop("repeat")


def repeated_folds(labels: DataFrame, k: int = 3, repeats: int | None = 1, seed: int | None = None) -> DataFrame:
    """(repeat, doc_id, label, fold); repeat r uses seed r (or ``seed`` when repeats is None)."""
    base = labels.select("doc_id", "label")
    if repeats is None:
        base = base.withColumn("repeat", F.lit(int(seed or 0)))
    else:
        base = base.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    ranked = _rank_in_class(base, F.col("repeat"), ["repeat", "label"])
    counts = base.groupBy("repeat", "label").agg(F.count(F.lit(1)).alias("n"))
    offs = _class_offsets(counts, ["repeat"]).select("repeat", "label", "class_offset")
    out = ranked.join(F.broadcast(offs), ["repeat", "label"])  # one row per (repeat, class)
    return out.select(F.col("repeat").cast("int").alias("repeat"), "doc_id", "label",
                      ((F.col("class_offset") + F.col("rank_in_class") - 1) % k).cast("int").alias("fold"))


def _largest_remainder(counts: DataFrame, draws: Column, total: Column, keys: Sequence[str]) -> DataFrame:
    """Per class: floor(n_c * draws / total) plus one for the largest remainders (ties: lower label)."""
    cont = F.col("n") * draws / total
    x = counts.withColumn("_cont", cont).withColumn("_fl", F.floor("_cont").cast("long"))
    w_all = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    x = x.withColumn("_need", (draws - F.sum("_fl").over(w_all)).cast("long"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(F.desc(F.col("_cont") - F.col("_fl")), "label")
    x = x.withColumn("_r", F.row_number().over(w))
    return x.withColumn("take", F.col("_fl") + F.when(F.col("_r") <= F.col("_need"), 1).otherwise(0)).drop(
        "_cont", "_fl", "_need", "_r")


def train_test_split(labels: DataFrame, test_size: float = 0.333, seed: int = 8) -> DataFrame:
    """D3: (doc_id, label, split): n_test = ceil(test_size * n); per-class train counts by
    largest remainder, the rest of each class is test; members by seeded rank."""
    base = labels.select("doc_id", "label")
    counts = base.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    n = F.sum("n").over(Window.partitionBy(F.lit(0)))
    counts = counts.withColumn("_tot", n).withColumn("_test", F.ceil(F.lit(float(test_size)) * F.col("_tot")))
    alloc = _largest_remainder(counts, F.col("_tot") - F.col("_test"), F.col("_tot"), [])
    alloc = alloc.select("label", (F.col("n") - F.col("take")).alias("n_test"))
    ranked = _rank_in_class(base.withColumn("_p", F.lit(0)), F.lit(str(seed)), ["_p", "label"]).drop("_p")
    out = ranked.join(F.broadcast(alloc), "label")  # one row per class
    return out.select("doc_id", "label",
                      F.when(F.col("rank_in_class") <= F.col("n_test"), "test").otherwise("train").alias("split"))


def learning_proportions(labels: DataFrame, proportions: Sequence[float] = LEARNING_PROPORTIONS) -> DataFrame:
    """The proportions to use; below 0.2 only when every class has >= 13 rows."""
    small = labels.groupBy("label").count().agg(
        F.min("count").alias("m")).select((F.col("m") < MIN_CLASS_FOR_SMALL_PROPORTIONS).alias("small"))
    props = small.select("small", F.explode(F.array(*[F.lit(float(p)) for p in proportions])).alias("proportion"))
    return props.filter(~F.col("small") | (F.col("proportion") >= 0.2)).select("proportion")


def learning_subsets(labels: DataFrame, k: int = 5, fold_seed: int = 42, subset_seed: int = 42,
                     proportions: Sequence[float] = LEARNING_PROPORTIONS) -> DataFrame:
    """For each validation fold and proportion p, a stratified share of the training rows.

    Size = ceil(p * n_train) for p < 1 (the 'test' side of a stratified split, as the
    reference does), all training rows for p = 1. Output (fold, proportion, doc_id, label).
    """
    folds = stratified_folds(labels, k, fold_seed)
    train = folds.withColumn("vfold", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).filter(
        F.col("fold") != F.col("vfold")).select(F.col("vfold").alias("fold"), "doc_id", "label")
    ranked = _rank_in_class(train, F.concat_ws("-", F.lit(str(subset_seed)), F.col("fold")), ["fold", "label"])
    props = learning_proportions(labels, proportions)
    counts = train.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("proportion", F.explode(F.array(*[F.lit(float(p)) for p in proportions])))
    counts = counts.join(F.broadcast(props), "proportion", "left_semi")
    keys = ["fold", "proportion"]
    tot = F.sum("n").over(Window.partitionBy(*keys))
    counts = counts.withColumn("_tot", tot).withColumn("_sub", F.ceil(F.col("proportion") * F.col("_tot")))
    alloc = _largest_remainder(counts, F.col("_tot") - F.col("_sub"), F.col("_tot"), keys)
    alloc = alloc.select(*keys, "label", F.when(F.col("proportion") >= 1.0, F.col("n")).otherwise(
        F.col("n") - F.col("take")).alias("n_take"))
    # alloc has folds x proportions x classes rows (bounded by the parameters)
    out = ranked.join(F.broadcast(alloc), ["fold", "label"])
    return out.filter(F.col("rank_in_class") <= F.col("n_take")).select(
        F.col("fold").cast("int").alias("fold"), "proportion", "doc_id", "label")
