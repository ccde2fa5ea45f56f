"""ROC, AUC, precision, thresholds, confusion, densities, histograms, gains.

Input is a score table ``(group..., label INT 0/1, score DOUBLE)``; every
operator works per group (``groups`` may be empty). Global cumulative counts
use the bucketed prefix scan on the *distinct-score* table, so a score shared
by a third of all rows is one row after the partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screensift.functions.hashing import seeded_hash
from screensift.functions.prefix import default_buckets, global_rank, hex_bucket, prefix_scan, quantile_bucket

INF = float("inf")


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def score_counts(scores: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., score, pos, neg): one row per distinct score (map-side combined)."""
    return scores.groupBy(*groups, "score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum((1 - F.col("label")).cast("long")).alias("neg"),
    )


def cumulative_counts(scores: DataFrame, groups: Sequence[str] = (), neighbours: bool = False,
                      n_buckets: int | None = None) -> DataFrame:
    """Distinct scores in descending order with running tps / fps and totals P / N."""
    sc = score_counts(scores, groups)
    nb = n_buckets or default_buckets(sc)
    sc = quantile_bucket(sc, "score", nb, descending=True, by=groups)(sc)
    out = prefix_scan(sc, list(groups), "_bk", -F.col("score"), ["pos", "neg"], neighbours)
    out = out.withColumnRenamed("pos_cum", "tps").withColumnRenamed("neg_cum", "fps")
    out = out.withColumnRenamed("pos_total", "P").withColumnRenamed("neg_total", "N")
    if neighbours:
        out = (out.withColumnRenamed("pos_cum_prev", "tps_prev").withColumnRenamed("pos_cum_next", "tps_next")
               .withColumnRenamed("neg_cum_prev", "fps_prev").withColumnRenamed("neg_cum_next", "fps_next"))
    return out.drop("_bk")


def roc_points(scores: DataFrame, groups: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Full ROC (every distinct score, plus the +inf start) with ``keep``: the point
    survives the library's thinning of collinear points (second differences)."""
    g = list(groups)
    cc = cumulative_counts(scores, g, neighbours=True, n_buckets=n_buckets)
    second_fps = F.col("fps_next") - 2 * F.col("fps") + F.col("fps_prev")
    second_tps = F.col("tps_next") - 2 * F.col("tps") + F.col("tps_prev")
    keep = (F.col("_idx") == 1) | (F.col("_idx") == F.col("_n")) | (second_fps != 0) | (second_tps != 0)
    pts = cc.select(*g, F.col("score").cast("double").alias("threshold"), "fps", "tps", "P", "N",
                    F.coalesce(keep, F.lit(False)).alias("keep"))
    start = cc.filter(F.col("_idx") == 1).select(
        *g, F.lit(INF).alias("threshold"), F.lit(0).cast("long").alias("fps"),
        F.lit(0).cast("long").alias("tps"), "P", "N", F.lit(True).alias("keep"))
    both = pts.unionByName(start)
    return both.select(*g, "threshold", F.col("fps").cast("long").alias("fps"),
                       F.col("tps").cast("long").alias("tps"),
                       _div(F.col("fps"), F.col("N")).alias("fpr"), _div(F.col("tps"), F.col("P")).alias("tpr"),
                       "keep")


def roc_curve(scores: DataFrame, groups: Sequence[str] = (), drop_intermediate: bool = True,
              n_buckets: int | None = None) -> DataFrame:
    """(groups..., threshold, fps, tps, fpr, tpr); first point (+inf, 0, 0)."""
    pts = roc_points(scores, groups, n_buckets)
    if drop_intermediate:
        pts = pts.filter(F.col("keep"))
    return pts.drop("keep")


def roc_auc(scores: DataFrame, groups: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """(groups..., auc, n_pos, n_neg); NULL when a group has one class only.

    Area = sum over distinct scores of pos_s * (2 * (negatives ranked below) + neg_s) / (2 P N),
    i.e. the trapezoid rule on the ROC, with ties counted half.
    """
    a = roc_aucs(scores, ["label"], groups, n_buckets)
    return a.select(*groups, F.col("label_auc").alias("auc"), F.col("label_n_pos").alias("n_pos"), F.col("label_n_neg").alias("n_neg"))


def roc_aucs(scores: DataFrame, labels: Sequence[str], groups: Sequence[str] = (), n_buckets: int | None = None,
             extremes: Sequence[str] = ()) -> DataFrame:
    """E2 of the same scores under several 0/1 label columns, in one pass: (groups..., and a label's
    ``<l>_auc``, ``<l>_n_pos``, ``<l>_n_neg``; ``<c>_min`` and ``<c>_max`` of the ``extremes``).

    A bucket's share of the area needs its own running counts and the negatives of later buckets alone, so
    each bucket becomes one row inside its window's tasks and only these rows meet per group: no distinct
    score is joined with totals. One bucket (``n_buckets`` 1) suits many small groups: rows partitioned by
    some of ``groups`` are not shuffled again, and a window that outgrows memory spills.
    """
    g = list(groups)
    sums = [F.sum(F.col(lab).cast("long")).alias(f"_p_{i}") for i, lab in enumerate(labels)]
    sums += [F.sum((1 - F.col(lab)).cast("long")).alias(f"_n_{i}") for i, lab in enumerate(labels)]
    sums += [f(c).alias(f"{c}_{name}") for c in extremes for name, f in (("min", F.min), ("max", F.max))]
    sc = scores.groupBy(*g, "score").agg(*sums)
    if n_buckets == 1:
        sc = sc.withColumn("_bk", F.lit(0))
    else:
        # bounds from the rows as given: a score's counts are not needed to place it
        sc = quantile_bucket(scores, "score", n_buckets or default_buckets(sc), descending=True, by=g)(sc)
    keys = g if n_buckets == 1 else [*g, "_bk"]
    upto = Window.partitionBy(*keys).orderBy(-F.col("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = [f(f"{c}_{name}").alias(f"{c}_{name}") for c in extremes for name, f in (("min", F.min), ("max", F.max))]
    for i in range(len(labels)):
        sc = sc.withColumn(f"_c_{i}", F.sum(f"_n_{i}").over(upto))
    for i in range(len(labels)):
        pos, neg = F.col(f"_p_{i}").cast("double"), F.col(f"_n_{i}")
        parts += [F.sum(pos * (neg - 2.0 * F.col(f"_c_{i}"))).alias(f"_s_{i}"), F.sum(f"_p_{i}").alias(f"_p_{i}"), F.sum(f"_n_{i}").alias(f"_n_{i}")]
    out = sc.groupBy(*keys).agg(*parts)
    if n_buckets == 1:
        seen = {i: F.col(f"_n_{i}") for i in range(len(labels))}  # negatives from the bucket's start on
    else:
        later = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.currentRow, Window.unboundedFollowing)
        for i in range(len(labels)):
            out = out.withColumn(f"_l_{i}", F.sum(f"_n_{i}").over(later))
        again = [f(f"{c}_{name}").alias(f"{c}_{name}") for c in extremes for name, f in (("min", F.min), ("max", F.max))]
        for i in range(len(labels)):
            again += [F.sum(F.col(f"_s_{i}") + 2.0 * F.col(f"_p_{i}") * F.col(f"_l_{i}")).alias(f"_s_{i}"),
                      F.sum(f"_p_{i}").alias(f"_p_{i}"), F.sum(f"_n_{i}").alias(f"_n_{i}")]
        out = out.groupBy(*g).agg(*again)
        seen = {}
    cols = [f"{c}_{name}" for c in extremes for name in ("min", "max")]
    for i, lab in enumerate(labels):
        p, n = F.col(f"_p_{i}"), F.col(f"_n_{i}")
        area = F.col(f"_s_{i}") + 2.0 * p * seen[i] if seen else F.col(f"_s_{i}")
        cols += [F.when((p > 0) & (n > 0), area / (2.0 * p * n)).alias(f"{lab}_auc"),
                 p.cast("long").alias(f"{lab}_n_pos"), n.cast("long").alias(f"{lab}_n_neg")]
    return out.select(*g, *cols)


def average_precision(scores: DataFrame, groups: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Step-wise AP = sum_s (pos_s / P) * precision_s over distinct scores, descending."""
    g = list(groups)
    cc = cumulative_counts(scores, g, n_buckets=n_buckets)
    term = F.col("pos").cast("double") / F.col("P") * F.col("tps") / (F.col("tps") + F.col("fps"))
    agg = cc.groupBy(*g).agg(F.sum(term).alias("ap"), F.first("P").alias("P"))
    return agg.select(*g, F.when(F.col("P") > 0, F.col("ap")).alias("average_precision"))


def threshold_for_tpr(scores: DataFrame, targets: Sequence[float], groups: Sequence[str] = (),
                      n_buckets: int | None = None) -> DataFrame:
    """Highest ROC threshold with tpr >= target; 'thinned' (the library default) and 'exact'.

    One ROC scan serves both variants (thinned = the points flagged ``keep``).
    """
    g = list(groups)
    tg = F.explode(F.array(*[F.lit(float(t)) for t in targets])).alias("target")
    roc = roc_points(scores, g, n_buckets).select(*g, "threshold", "tpr", "keep", tg)
    hit = roc.filter(F.col("tpr") >= F.col("target"))
    best = hit.groupBy(*g, "target").agg(
        F.max(F.when(F.col("keep"), F.col("threshold"))).alias("thinned"), F.max("threshold").alias("exact"))
    long = best.select(*g, "target", F.explode(F.array(
        F.struct(F.lit("thinned").alias("variant"), F.col("thinned").alias("threshold")),
        F.struct(F.lit("exact").alias("variant"), F.col("exact").alias("threshold")))).alias("v"))
    return long.select(*g, "v.variant", "target", "v.threshold").filter(F.col("threshold").isNotNull())


def confusion(scores: DataFrame, threshold: float | Column, groups: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP at ``score >= threshold`` (per group, e.g. split)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col("score") >= t
    lab = F.col("label") == 1
    return scores.groupBy(*groups).agg(
        F.count_if(~lab & ~pred).cast("long").alias("tn"),
        F.count_if(~lab & pred).cast("long").alias("fp"),
        F.count_if(lab & ~pred).cast("long").alias("fn"),
        F.count_if(lab & pred).cast("long").alias("tp"),
    )


def confusion_layout(conf: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Display layout [[FP, TN], [TP, FN]] as rows (groups..., row, col, cell, count)."""
    cells = [(0, 0, "fp"), (0, 1, "tn"), (1, 0, "tp"), (1, 1, "fn")]
    arr = F.array(*[F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(n).alias("cell"),
                             F.col(n).alias("count")) for r, c, n in cells])
    return conf.select(*groups, F.inline(arr))


def recall_fpr(conf: DataFrame) -> DataFrame:
    """recall = TP/(TP+FN) (0 without positives); fpr = 1 - TN/(TN+FP) (1 without negatives)."""
    recall = F.coalesce(_div(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    spec = F.coalesce(_div(F.col("tn"), F.col("tn") + F.col("fp")), F.lit(0.0))
    return conf.withColumn("recall", recall).withColumn("fpr", 1.0 - spec)


def with_metrics(conf: DataFrame) -> DataFrame:
    """E9 metric set from TN/FP/FN/TP, zero-guarded like the interactive page."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    tpr = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    fpr = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(0.0)
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    denom = 16.0 * prec + tpr
    return conf.select(
        "*",
        _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        (0.5 * (tpr + (1.0 - fpr))).alias("balanced_accuracy"),
        tpr.alias("recall"), prec.alias("precision"), (1.0 - fpr).alias("specificity"),
        fpr.alias("fpr"),
        (17.0 * prec * tpr / F.when(denom != 0, denom).otherwise(1.0)).alias("f4"),
    )


def threshold_sweep(scores: DataFrame, groups: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Confusion cells and metrics with every distinct score as the threshold."""
    g = list(groups)
    cc = cumulative_counts(scores, g, n_buckets=n_buckets)
    conf = cc.select(*g, F.col("score").cast("double").alias("threshold"),
                     (F.col("N") - F.col("fps")).cast("long").alias("tn"), F.col("fps").cast("long").alias("fp"),
                     (F.col("P") - F.col("tps")).cast("long").alias("fn"), F.col("tps").cast("long").alias("tp"))
    return with_metrics(conf)


def proportion_above(scores: DataFrame, threshold: float, groups: Sequence[str] = ()) -> DataFrame:
    """Share of rows with score >= threshold (the workload)."""
    return scores.groupBy(*groups).agg(
        F.avg((F.col("score") >= F.lit(float(threshold))).cast("double")).alias("proportion_above"))


# ---- distributions -------------------------------------------------------------

def histogram(df: DataFrame, col: str, bin_size: float, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., bin, bin_start, count) with bin = floor(x / bin_size)."""
    b = F.floor(F.col(col) / F.lit(float(bin_size))).cast("long")
    return df.filter(F.col(col).isNotNull()).groupBy(*groups, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count")).withColumn("bin_start", F.col("bin") * F.lit(float(bin_size)))


def quantiles_from_counts(vc: DataFrame, probs: Sequence[float], groups: Sequence[str] = (),
                          n_buckets: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles from a (groups..., v, c) table of value counts."""
    g = list(groups)
    nb = n_buckets or default_buckets(vc)
    vc = quantile_bucket(vc, "v", nb, by=g)(vc)
    ranked = prefix_scan(vc, g, "_bk", F.col("v"), ["c"])  # c_cum, c_total
    first = F.col("c_cum") - F.col("c")  # 0-based rank of the first copy
    ps = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")
    x = ranked.select(*g, "v", first.alias("r0"), F.col("c_cum").alias("r1"), F.col("c_total").alias("n"), ps)
    h = (F.col("n") - 1) * F.col("p")
    lo, hi = F.floor(h), F.ceil(h)
    x = x.withColumn("h", h).filter(
        ((F.col("r0") <= lo) & (lo < F.col("r1"))) | ((F.col("r0") <= hi) & (hi < F.col("r1"))))
    agg = x.groupBy(*g, "p").agg(
        F.max(F.when((F.col("r0") <= F.floor("h")) & (F.floor("h") < F.col("r1")), F.col("v"))).alias("vlo"),
        F.max(F.when((F.col("r0") <= F.ceil("h")) & (F.ceil("h") < F.col("r1")), F.col("v"))).alias("vhi"),
        F.first("h").alias("h"))
    q = F.col("vlo") + (F.col("h") - F.floor("h")) * (F.col("vhi") - F.col("vlo"))
    return agg.select(*g, "p", q.alias("q"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], groups: Sequence[str] = (),
                    n_buckets: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy default) without buffering a group in one task.

    Distinct values are counted (partial aggregation), ranked by a prefix scan
    and the two ranks around (n - 1) * p are looked up per p.
    """
    g = list(groups)
    vc = df.filter(F.col(col).isNotNull()).groupBy(*g, F.col(col).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c"))
    return quantiles_from_counts(vc, probs, g, n_buckets)


def summary(df: DataFrame, col: str, groups: Sequence[str] = ()) -> DataFrame:
    """Mean, median, population std, min, max (median via exact_quantiles)."""
    g = list(groups)
    basic = df.groupBy(*g).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"),
                               F.min(F.col(col).cast("double")).alias("min"),
                               F.max(F.col(col).cast("double")).alias("max"),
                               F.count(col).alias("n"))
    med = exact_quantiles(df, col, [0.5], g).select(*g, F.col("q").alias("median"))
    return basic.join(med, g, "left") if g else _one_row_join(basic, med)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    # both sides have exactly one row; join on a constant key
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")


def box_stats(df: DataFrame, col: str, groups: Sequence[str]) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per box."""
    g = list(groups)
    qs = exact_quantiles(df, col, [0.25, 0.5, 0.75], g)
    wide = qs.groupBy(*g).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    x = F.col(col).cast("double")
    # one row per box: bounded by the number of boxes, broadcast
    joined = df.select(*g, x.alias("x")).join(F.broadcast(wide), g)
    return joined.groupBy(*g).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(F.col("x") >= lo_f, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= hi_f, F.col("x"))).alias("whisker_high"),
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))


# ---- kernel density ------------------------------------------------------------

GRID_POINTS = 500


def score_density(scores: DataFrame, groups: Sequence[str] = ("label",), grid_points: int = GRID_POINTS,
                  bin_width: float | None = None, curve_type: str = "kde") -> DataFrame:
    """Gaussian KDE per group, Scott bandwidth, grid x_i = min + i (max - min) / grid_points.

    Scores are first reduced to (value, weight) -- distinct values, or bins of
    ``bin_width`` when given -- and each value adds its term to every grid point, so
    work is linear in the distinct values and sums combine before the shuffle.
    """
    g = list(groups)
    if not g:
        scores, g = scores.withColumn("_g", F.lit(0)), ["_g"]
    s = F.col("score").cast("double")
    stats = scores.groupBy(*g).agg(F.min(s).alias("lo"), F.max(s).alias("hi"), F.count(s).alias("n"),
                                   F.stddev_samp(s).alias("sd"))
    stats = stats.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).withColumn(
        "step", (F.col("hi") - F.col("lo")) / F.lit(float(grid_points)))
    if curve_type == "normal":
        # fitted normal (mean, population std) on the same grid; one row per group
        mom = scores.groupBy(*g).agg(F.avg(s).alias("mu"), F.stddev_pop(s).alias("sig"))
        st = stats.join(F.broadcast(mom), g).filter(F.col("step") > 0)
        grid = st.select(*g, "lo", "step", "mu", "sig",
                         F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("i"))
        x = F.col("lo") + F.col("i") * F.col("step")
        z = (x - F.col("mu")) / F.col("sig")
        dens = F.exp(-0.5 * z * z) / (F.col("sig") * F.lit((2 * 3.141592653589793) ** 0.5))
        return grid.select(*g, F.col("i").cast("int").alias("i"), x.alias("x"), dens.alias("density"))
    if curve_type != "kde":
        raise ValueError("curve_type must be 'kde' or 'normal'")
    v = F.floor(s / bin_width) * bin_width + bin_width / 2 if bin_width else s
    pts = scores.groupBy(*g, v.alias("v")).agg(F.count(F.lit(1)).alias("w"))
    # one row per group (bounded by the number of classes/groups)
    joined = pts.join(F.broadcast(stats), g)
    near = joined.filter(F.col("step") > 0).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
    x = F.col("lo") + F.col("i") * F.col("step")
    z = (x - F.col("v")) / F.col("bw")
    dens = near.groupBy(*g, "i").agg(
        F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_k"), F.first("lo").alias("lo"),
        F.first("step").alias("step"), F.first("n").alias("n"), F.first("bw").alias("bw"))
    grid = F.broadcast(stats.filter(F.col("step") > 0).select(
        *g, F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("i")))
    full = grid.join(dens.select(*g, "i", "_k"), g + ["i"], "left").join(F.broadcast(stats), g)
    y = F.coalesce(F.col("_k"), F.lit(0.0)) / (F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5))
    return full.select(*g, F.col("i").cast("int").alias("i"), (F.col("lo") + F.col("i") * F.col("step")).alias("x"),
                       y.alias("density"))


def density_split(density: DataFrame, threshold: float, groups: Sequence[str] = ("label",)) -> DataFrame:
    """Cut each density curve at the threshold with a linearly interpolated point.

    Output (groups..., side, seq, x, y): side 'below' holds points with x < t
    plus the cut, 'above' the cut plus points with x >= t. No cut point when
    the threshold is at or below the first grid point.
    """
    g = list(groups)
    t = F.lit(float(threshold))
    w = Window.partitionBy(*g).orderBy("i")
    d = density.withColumn("px", F.lag("x").over(w)).withColumn("py", F.lag("density").over(w))
    split = d.filter(F.col("x") >= t).groupBy(*g).agg(F.min_by(F.struct("i", "x", "density", "px", "py"), "i").alias("s"))
    cut_y = F.col("s.density") + (t - F.col("s.x")) * (F.col("s.density") - F.col("s.py")) / (F.col("s.x") - F.col("s.px"))
    cut = split.filter(F.col("s.i") > 0).select(*g, F.col("s.i").alias("idx"), cut_y.alias("y"))
    pts = density.join(split.select(*g, F.col("s.i").alias("idx")), g, "left").withColumn(
        "idx", F.coalesce("idx", F.lit(2 ** 31 - 1)))
    below = pts.filter(F.col("i") < F.col("idx")).select(*g, F.lit("below").alias("side"),
                                                          F.col("i").alias("seq"), "x", F.col("density").alias("y"))
    above = pts.filter(F.col("i") >= F.col("idx")).select(*g, F.lit("above").alias("side"),
                                                           (F.col("i") + 1).alias("seq"), "x", F.col("density").alias("y"))
    cut_b = cut.select(*g, F.lit("below").alias("side"), F.col("idx").alias("seq"), t.alias("x"), "y")
    cut_a = cut.select(*g, F.lit("above").alias("side"), F.col("idx").alias("seq"), t.alias("x"), "y")
    return below.unionByName(above).unionByName(cut_b).unionByName(cut_a)


# ---- cumulative gains ----------------------------------------------------------

def gains_order_hash(key_cols: Sequence[str]) -> Column:
    return seeded_hash(*[F.col(c) for c in key_cols])


def cumulative_gains(scores: DataFrame, key_cols: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """Rows sorted by score desc (ties: negatives first, then md5 of the key).

    (i, x = i / n, y = positives in the first i rows / P, threshold = score of row i);
    row 0 is (0, 0, +inf). Offsets of each tie group come from the distinct-score
    running counts; the rank inside a (score, label) tie group is a prefix scan
    bucketed by hash prefix, so a score shared by a third of all rows is still
    spread over many tasks.
    """
    cc = cumulative_counts(scores, (), n_buckets=n_buckets).select(
        "score", "pos", "neg", "tps", "fps", "P", "N")
    base = scores.select("label", "score", gains_order_hash(key_cols).alias("h"))
    ranked = global_rank(base, ["score", "label"], F.col("h"),
                         hex_bucket(F.col("h"), n_buckets or default_buckets(base)))
    j = ranked.join(cc, "score")
    before = F.col("tps") + F.col("fps") - F.col("pos") - F.col("neg")
    is_pos = F.col("label") == 1
    i = before + F.when(is_pos, F.col("neg")).otherwise(F.lit(0)) + F.col("_idx")
    cp = F.col("tps") - F.col("pos") + F.when(is_pos, F.col("_idx")).otherwise(F.lit(0))
    n = F.col("P") + F.col("N")
    rows = j.select(i.cast("long").alias("i"), _div(i, n).alias("x"), _div(cp, F.col("P")).alias("y"),
                    F.col("score").cast("double").alias("threshold"))
    start = cc.limit(1).select(F.lit(0).cast("long").alias("i"), F.lit(0.0).alias("x"),
                               F.lit(0.0).alias("y"), F.lit(INF).alias("threshold"))
    return rows.unionByName(start)


def threshold_for_recall(gains: DataFrame, recalls_percent: Sequence[float]) -> DataFrame:
    """For recall r%: the largest i < n with 100 * y_i < r; threshold = score of row i + 1."""
    n = gains.agg(F.max("i")).scalar()
    tg = gains.select("i", "y", F.explode(F.array(*[F.lit(float(r)) for r in recalls_percent])).alias("recall"))
    best = tg.filter((F.col("i") < n) & (100.0 * F.col("y") < F.col("recall"))).groupBy("recall").agg(
        F.max("i").alias("i"))
    nxt = gains.select((F.col("i") - 1).alias("i"), "threshold")
    return best.join(nxt, "i").select("recall", (F.col("i") + 1).alias("rows_above"), "threshold")
