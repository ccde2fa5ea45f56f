"""Queries: evaluation, threshold and distribution analytics (E1-E19) on a score table.

Score table: lineitem proxy (label l_returnflag = 'R', score round(q * (1 - d), 2),
model = l_linestatus, fold = l_linenumber); 60k rows, 511 distinct scores at sf0.01.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from screensift.operators import metrics as M
from screensift.plans.registry import register
from screensift.plans.sql_metrics import ctes_cum, density_ctes, metrics_cols, roc_select, roc_sql
from screensift.plans.sql_text import r6
from screensift.sources.tables import SQL_PROXY_SCORES, proxy_scores

THRESHOLD = 20.0
TPR_TARGETS = (0.0, 0.5, 0.9, 0.95, 1.0)
RECALL_TARGETS = (50.0, 80.0, 90.0, 95.0, 99.0, 100.0)
def split_col():
    return F.when(F.col("lnum") <= 4, "train").when(F.col("lnum") <= 6, "valid").otherwise("test")
SQL_SPLIT = "CASE WHEN lnum <= 4 THEN 'train' WHEN lnum <= 6 THEN 'valid' ELSE 'test' END"


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _roc_out(df, groups=()):
    return df.select(*groups, R("threshold").alias("threshold"), "fps", "tps", R("fpr").alias("fpr"),
                     R("tpr").alias("tpr"))


@register("roc_curve", roc_sql() + "\n" + roc_select())
def q_roc_curve(spark, sf):
    return _roc_out(M.roc_curve(proxy_scores(spark, sf)))


@register("roc_curve_full", roc_sql(thin=False) + "\n" + roc_select())
def q_roc_curve_full(spark, sf):
    return _roc_out(M.roc_curve(proxy_scores(spark, sf), drop_intermediate=False))


@register("roc_curve_by_group", roc_sql(("model", "fold")) + "\n" + roc_select(("model", "fold")))
def q_roc_curve_by_group(spark, sf):
    return _roc_out(M.roc_curve(proxy_scores(spark, sf), ["model", "fold"]), ["model", "fold"])


def _auc_sql(groups=()):
    g = list(groups)
    gs = "".join(f"{c}, " for c in g)
    gb = ("GROUP BY " + ", ".join(g)) if g else ""
    return f"""WITH {SQL_PROXY_SCORES},
{ctes_cum(g)}
SELECT {gs}CASE WHEN max(P) > 0 AND max(N) > 0 THEN
    {r6('sum(CAST(pos AS DOUBLE) * (2.0 * (N - fps) + neg)) / (2.0 * max(P) * max(N))')} END AS auc,
  max(P) AS n_pos, max(N) AS n_neg
FROM cc {gb}"""


@register("roc_auc", _auc_sql())
def q_roc_auc(spark, sf):
    return M.roc_auc(proxy_scores(spark, sf)).select(R("auc").alias("auc"), "n_pos", "n_neg")


@register("roc_auc_by_group", _auc_sql(("model", "fold")))
def q_roc_auc_by_group(spark, sf):
    return M.roc_auc(proxy_scores(spark, sf), ["model", "fold"]).select(
        "model", "fold", R("auc").alias("auc"), "n_pos", "n_neg")


@register("average_precision", f"""WITH {SQL_PROXY_SCORES},
{ctes_cum(("model",))}
SELECT model, {r6('sum(CAST(pos AS DOUBLE) / P * tps / (tps + fps))')} AS average_precision
FROM cc GROUP BY model""")
def q_average_precision(spark, sf):
    ap = M.average_precision(proxy_scores(spark, sf), ["model"])
    return ap.select("model", R("average_precision").alias("average_precision"))


def _tpr_sql():
    targets = ", ".join(f"({t})" for t in TPR_TARGETS)
    thin = roc_sql().replace("WITH ", "WITH ", 1)
    full = roc_sql(thin=False)
    return f"""WITH thinned AS ({thin} SELECT * FROM roc),
full_roc AS ({full} SELECT * FROM roc),
t(target) AS (VALUES {targets}),
both_roc AS (SELECT 'thinned' AS variant, threshold, CAST(tps AS DOUBLE) / P AS tpr FROM thinned
             UNION ALL SELECT 'exact', threshold, CAST(tps AS DOUBLE) / P FROM full_roc)
SELECT variant, CAST(target AS DOUBLE) AS target, {r6('max(threshold)')} AS threshold
FROM both_roc, t WHERE tpr >= target GROUP BY variant, target"""


@register("threshold_for_tpr", _tpr_sql())
def q_threshold_for_tpr(spark, sf):
    out = M.threshold_for_tpr(proxy_scores(spark, sf), TPR_TARGETS)
    return out.select("variant", "target", R("threshold").alias("threshold"))


def _conf_sql(group_expr=None, group_name=None, extra=""):
    sel = f"{group_expr} AS {group_name}, " if group_expr else ""
    gb = f"GROUP BY {group_expr}" if group_expr else ""
    return f"""WITH {SQL_PROXY_SCORES},
conf AS (SELECT {sel}CAST(count_if(label = 0 AND score < {THRESHOLD}) AS BIGINT) AS tn,
  CAST(count_if(label = 0 AND score >= {THRESHOLD}) AS BIGINT) AS fp,
  CAST(count_if(label = 1 AND score < {THRESHOLD}) AS BIGINT) AS fn,
  CAST(count_if(label = 1 AND score >= {THRESHOLD}) AS BIGINT) AS tp
  FROM scores {gb})"""


@register("confusion", _conf_sql() + "\nSELECT tn, fp, fn, tp FROM conf")
def q_confusion(spark, sf):
    return M.confusion(proxy_scores(spark, sf), THRESHOLD)


@register("confusion_by_split", _conf_sql(SQL_SPLIT, "split") + """
SELECT split, cell, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, count FROM (
  SELECT split, 'fp' AS cell, 0 AS r, 0 AS c, fp AS count FROM conf UNION ALL
  SELECT split, 'tn', 0, 1, tn FROM conf UNION ALL
  SELECT split, 'tp', 1, 0, tp FROM conf UNION ALL
  SELECT split, 'fn', 1, 1, fn FROM conf)""")
def q_confusion_by_split(spark, sf):
    sc = proxy_scores(spark, sf).withColumn("split", split_col())
    return M.confusion_layout(M.confusion(sc, THRESHOLD, ["split"]), ["split"])


@register("recall_fpr", f"""WITH {SQL_PROXY_SCORES},
conf AS (SELECT model, fold, count_if(label = 0 AND score < {THRESHOLD}) AS tn,
  count_if(label = 0 AND score >= {THRESHOLD}) AS fp, count_if(label = 1 AND score < {THRESHOLD}) AS fn,
  count_if(label = 1 AND score >= {THRESHOLD}) AS tp FROM scores GROUP BY model, fold)
SELECT model, fold, {r6('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)')} AS recall,
  {r6('1.0 - coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0)')} AS fpr FROM conf""")
def q_recall_fpr(spark, sf):
    rf = M.recall_fpr(M.confusion(proxy_scores(spark, sf), THRESHOLD, ["model", "fold"]))
    return rf.select("model", "fold", R("recall").alias("recall"), R("fpr").alias("fpr"))


METRIC_COLS = ["accuracy", "balanced_accuracy", "recall", "precision", "specificity", "fpr", "f4"]


@register("threshold_metrics", _conf_sql() + f"\nSELECT tn, fp, fn, tp, {metrics_cols()} FROM conf")
def q_threshold_metrics(spark, sf):
    m = M.with_metrics(M.confusion(proxy_scores(spark, sf), THRESHOLD))
    return m.select("tn", "fp", "fn", "tp", *[R(c).alias(c) for c in METRIC_COLS])


@register("threshold_sweep", f"""WITH {SQL_PROXY_SCORES},
{ctes_cum()},
conf AS (SELECT CAST(score AS DOUBLE) AS threshold, N - fps AS tn, fps AS fp, P - tps AS fn, tps AS tp FROM cc)
SELECT {r6('threshold')} AS threshold, tn, fp, fn, tp, {metrics_cols()} FROM conf""")
def q_threshold_sweep(spark, sf):
    m = M.threshold_sweep(proxy_scores(spark, sf))
    return m.select(R("threshold").alias("threshold"), "tn", "fp", "fn", "tp",
                    *[R(c).alias(c) for c in METRIC_COLS])


@register("proportion_above", f"""WITH {SQL_PROXY_SCORES}
SELECT model, {r6(f'avg(CAST(score >= {THRESHOLD} AS DOUBLE))')} AS proportion_above FROM scores GROUP BY model""")
def q_proportion_above(spark, sf):
    pa = M.proportion_above(proxy_scores(spark, sf), THRESHOLD, ["model"])
    return pa.select("model", R("proportion_above").alias("proportion_above"))


@register("score_density", f"""WITH {SQL_PROXY_SCORES},
{density_ctes()}
SELECT label, CAST(i AS INTEGER) AS i, {r6('x')} AS x, {r6('density')} AS density FROM dens""")
def q_score_density(spark, sf):
    d = M.score_density(proxy_scores(spark, sf), ["label"])
    return d.select("label", "i", R("x").alias("x"), R("density").alias("density"))


@register("density_split", f"""WITH {SQL_PROXY_SCORES},
{density_ctes()},
lagged AS (SELECT *, lag(x) OVER (PARTITION BY label ORDER BY i) AS px,
                  lag(density) OVER (PARTITION BY label ORDER BY i) AS py FROM dens),
cut AS (SELECT label, arg_min(i, i) AS idx,
               arg_min(density + ({THRESHOLD} - x) * (density - py) / (x - px), i) AS y
        FROM lagged WHERE x >= {THRESHOLD} GROUP BY label),
cpts AS (SELECT d.*, coalesce(c.idx, 2147483647) AS idx FROM dens d LEFT JOIN cut c USING (label))
SELECT label, side, CAST(seq AS INTEGER) AS seq, {r6('x')} AS x, {r6('y')} AS y FROM (
  SELECT label, 'below' AS side, i AS seq, x, density AS y FROM cpts WHERE i < idx
  UNION ALL SELECT label, 'above', i + 1, x, density FROM cpts WHERE i >= idx
  UNION ALL SELECT label, 'below', idx, {THRESHOLD}, y FROM cut WHERE idx > 0
  UNION ALL SELECT label, 'above', idx, {THRESHOLD}, y FROM cut WHERE idx > 0)""")
def q_density_split(spark, sf):
    d = M.score_density(proxy_scores(spark, sf), ["label"])
    s = M.density_split(d, THRESHOLD, ["label"])
    return s.select("label", "side", F.col("seq").cast("int").alias("seq"), R("x").alias("x"), R("y").alias("y"))


@register("metric_histogram", f"""WITH {SQL_PROXY_SCORES},
{ctes_cum()},
m AS (SELECT CASE WHEN P > 0 THEN CAST(tps AS DOUBLE) / P ELSE 0.0 END AS recall FROM cc)
SELECT CAST(floor(recall / 0.005) AS BIGINT) AS bin, {r6('floor(recall / 0.005) * 0.005')} AS bin_start,
       count(*) AS count FROM m GROUP BY 1, 2""")
def q_metric_histogram(spark, sf):
    sweep = M.threshold_sweep(proxy_scores(spark, sf))
    h = M.histogram(sweep, "recall", 0.005)
    return h.select("bin", R("bin_start").alias("bin_start"), "count")


@register("metric_summary", f"""WITH {SQL_PROXY_SCORES}
SELECT model, {r6('avg(score)')} AS mean, {r6('median(score)')} AS median, {r6('stddev_pop(score)')} AS std,
       {r6('min(score)')} AS min, {r6('max(score)')} AS max, count(score) AS n FROM scores GROUP BY model""")
def q_metric_summary(spark, sf):
    s = M.summary(proxy_scores(spark, sf), "score", ["model"])
    return s.select("model", *[R(c).alias(c) for c in ("mean", "median", "std", "min", "max")], "n")


@register("score_histogram", f"""WITH {SQL_PROXY_SCORES}
SELECT label, CAST(floor(score / 1.0) AS BIGINT) AS bin, {r6('floor(score / 1.0) * 1.0')} AS bin_start,
       count(*) AS count FROM scores GROUP BY 1, 2, 3""")
def q_score_histogram(spark, sf):
    h = M.histogram(proxy_scores(spark, sf), "score", 1.0, ["label"])
    return h.select("label", "bin", R("bin_start").alias("bin_start"), "count")


@register("fold_box_stats", f"""WITH {SQL_PROXY_SCORES},
q AS (SELECT fold, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS med,
             quantile_cont(score, 0.75) AS q3 FROM scores GROUP BY fold)
SELECT fold, {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3,
  {r6('min(score) FILTER (WHERE score >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
  {r6('max(score) FILTER (WHERE score <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  count(*) AS n, {r6('avg(score)')} AS mean
FROM scores JOIN q USING (fold) GROUP BY fold, q1, med, q3""")
def q_fold_box_stats(spark, sf):
    b = M.box_stats(proxy_scores(spark, sf), "score", ["fold"])
    return b.select("fold", *[R(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                    "n", R("mean").alias("mean"))


GAIN_KEYS = ["okey", "pkey", "skey", "lnum"]
SQL_GAINS = f"""{SQL_PROXY_SCORES},
base AS (SELECT label, CAST(score AS DOUBLE) AS score, md5(concat_ws('-', okey, pkey, skey, lnum)) AS h FROM scores),
r AS (SELECT row_number() OVER w AS i, count(*) OVER () AS n,
        sum(label) OVER (w ROWS UNBOUNDED PRECEDING) AS cp, sum(label) OVER () AS P, score
      FROM base WINDOW w AS (ORDER BY score DESC, label, h)),
gains AS (SELECT CAST(i AS BIGINT) AS i, CAST(i AS DOUBLE) / n AS x, CAST(cp AS DOUBLE) / P AS y,
                 score AS threshold FROM r
          UNION ALL SELECT 0, 0.0, 0.0, CAST('inf' AS DOUBLE))"""


@register("cumulative_gains", f"""WITH {SQL_GAINS}
SELECT i, {r6('x')} AS x, {r6('y')} AS y, {r6('threshold')} AS threshold FROM gains""")
def q_cumulative_gains(spark, sf):
    g = M.cumulative_gains(proxy_scores(spark, sf), GAIN_KEYS)
    return g.select("i", R("x").alias("x"), R("y").alias("y"), R("threshold").alias("threshold"))


@register("threshold_for_recall", f"""WITH {SQL_GAINS},
t(recall) AS (VALUES {", ".join(f"({r})" for r in RECALL_TARGETS)}),
best AS (SELECT recall, max(i) AS i FROM gains, t
         WHERE i < (SELECT max(i) FROM gains) AND 100.0 * y < recall GROUP BY recall)
SELECT CAST(b.recall AS DOUBLE) AS recall, b.i + 1 AS rows_above, {r6('g.threshold')} AS threshold
FROM best b JOIN gains g ON g.i = b.i + 1""")
def q_threshold_for_recall(spark, sf):
    g = M.cumulative_gains(proxy_scores(spark, sf), GAIN_KEYS)
    t = M.threshold_for_recall(g, RECALL_TARGETS)
    return t.select("recall", "rows_above", R("threshold").alias("threshold"))
