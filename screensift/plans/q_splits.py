"""Queries: folds, hold-out and learning-curve subsets."""

from __future__ import annotations

from screensift.operators import labels as lb
from screensift.operators import splits as sp
from screensift.plans.registry import register
from screensift.sources import tables as tb

K = 3
REPEATS = 5


def label_df(spark, sf):
    return lb.binarize(tb.label_table(spark, sf), "label", "1")


SQL_LAB = "lab AS (SELECT doc_id, CAST(toxic = 1 AS INTEGER) AS label FROM labels)"


def sql_folds(k, seed_expr, part="", src="lab") -> str:
    pp = f"{part}, " if part else ""
    return f"""r AS (SELECT {pp}doc_id, label, row_number() OVER (PARTITION BY {pp}label
                ORDER BY md5(concat_ws('-', {seed_expr}, doc_id)), doc_id) AS rk FROM {src}),
cnt AS (SELECT {pp}label, count(*) AS c FROM {src} GROUP BY {pp}label),
off AS (SELECT {pp}label, coalesce(sum(c) OVER ({"PARTITION BY " + part if part else ""} ORDER BY label
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM cnt),
folds AS (SELECT {pp}doc_id, label, CAST((o + rk - 1) % {k} AS INTEGER) AS fold FROM r JOIN off USING ({pp}label))"""


def sql_largest_remainder(src: str, keys: list[str], draws: str, total: str) -> str:
    """CTE body: src rows (keys..., label, n, ...) -> adds take."""
    pk = ("PARTITION BY " + ", ".join(keys)) if keys else ""
    return f"""SELECT *, fl + CASE WHEN rr <= need THEN 1 ELSE 0 END AS take FROM (
    SELECT *, row_number() OVER ({pk} ORDER BY cont - fl DESC, label) AS rr,
           {draws} - sum(fl) OVER ({pk}) AS need FROM (
      SELECT *, CAST(n AS DOUBLE) * ({draws}) / ({total}) AS cont,
             floor(CAST(n AS DOUBLE) * ({draws}) / ({total})) AS fl FROM {src}))"""


@register("stratified_folds", f"""WITH {SQL_LAB},
{sql_folds(K, "0")}
SELECT doc_id, label, fold FROM folds""")
def q_stratified_folds(spark, sf):
    return sp.stratified_folds(label_df(spark, sf), K, 0)


@register("repeated_folds", f"""WITH {SQL_LAB},
rl AS (SELECT CAST(rep AS INTEGER) AS repeat, doc_id, label FROM lab, range({REPEATS}) t(rep)),
{sql_folds(K, "repeat", "repeat", "rl")}
SELECT repeat, doc_id, label, fold FROM folds""")
def q_repeated_folds(spark, sf):
    return sp.repeated_folds(label_df(spark, sf), K, REPEATS)


@register("fold_class_counts", f"""WITH {SQL_LAB},
rl AS (SELECT CAST(rep AS INTEGER) AS repeat, doc_id, label FROM lab, range({REPEATS}) t(rep)),
{sql_folds(K, "repeat", "repeat", "rl")}
SELECT repeat, fold, label, count(*) AS n FROM folds GROUP BY ALL""")
def q_fold_class_counts(spark, sf):
    f = sp.repeated_folds(label_df(spark, sf), K, REPEATS)
    return f.groupBy("repeat", "fold", "label").count().withColumnRenamed("count", "n")


@register("train_test_split", f"""WITH {SQL_LAB},
cnt AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS tot,
               ceil(0.333 * sum(count(*)) OVER ()) AS ntest FROM lab GROUP BY label),
alloc AS ({sql_largest_remainder("cnt", [], "tot - ntest", "tot")}),
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label
        ORDER BY md5(concat_ws('-', 8, doc_id)), doc_id) AS rk FROM lab)
SELECT doc_id, r.label, CASE WHEN rk <= n - take THEN 'test' ELSE 'train' END AS split
FROM r JOIN alloc USING (label)""")
def q_train_test_split(spark, sf):
    return sp.train_test_split(label_df(spark, sf), 0.333, 8)


SQL_PROPS = "(VALUES " + ", ".join(f"({p})" for p in sp.LEARNING_PROPORTIONS) + ") pr(proportion)"


@register("learning_proportions", f"""WITH {SQL_LAB},
small AS (SELECT min(c) < 13 AS s FROM (SELECT label, count(*) AS c FROM lab GROUP BY label))
SELECT CAST(proportion AS DOUBLE) AS proportion FROM {SQL_PROPS}, small WHERE NOT s OR proportion >= 0.2""")
def q_learning_proportions(spark, sf):
    return sp.learning_proportions(label_df(spark, sf))


SQL_SUBSETS = f"""{SQL_LAB},
{sql_folds(5, "42")},
train AS (SELECT v.vfold AS fold, f.doc_id, f.label FROM folds f, range(5) v(vfold) WHERE f.fold <> v.vfold),
small AS (SELECT min(c) < 13 AS s FROM (SELECT label, count(*) AS c FROM lab GROUP BY label)),
props AS (SELECT CAST(proportion AS DOUBLE) AS proportion FROM {SQL_PROPS}, small WHERE NOT s OR proportion >= 0.2),
tcnt AS (SELECT fold, label, count(*) AS n FROM train GROUP BY fold, label),
tcp AS (SELECT tcnt.*, p.proportion, sum(n) OVER (PARTITION BY fold, proportion) AS tot,
               ceil(p.proportion * sum(n) OVER (PARTITION BY fold, proportion)) AS sub FROM tcnt, props p),
alloc AS ({sql_largest_remainder("tcp", ["fold", "proportion"], "tot - sub", "tot")}),
rk AS (SELECT fold, doc_id, label, row_number() OVER (PARTITION BY fold, label
         ORDER BY md5(concat_ws('-', 42, fold, doc_id)), doc_id) AS r FROM train),
subsets AS (SELECT CAST(rk.fold AS INTEGER) AS fold, a.proportion, rk.doc_id, rk.label FROM rk
            JOIN alloc a ON a.fold = rk.fold AND a.label = rk.label
            WHERE rk.r <= CASE WHEN a.proportion >= 1.0 THEN a.n ELSE a.n - a.take END)"""


@register("learning_subsets", f"""WITH {SQL_SUBSETS}
SELECT fold, proportion, doc_id, label FROM subsets""")
def q_learning_subsets(spark, sf):
    return sp.learning_subsets(label_df(spark, sf))
