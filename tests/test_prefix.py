"""The bucketed prefix scan equals a plain window, whatever the bucketing."""

import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from screensift.functions.prefix import global_rank, prefix_scan, quantile_bucket


@pytest.mark.parametrize("seed,n_buckets", [(1, 3), (2, 7), (3, 1)])
def test_prefix_scan_matches_window(spark, seed, n_buckets):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", "c"]), i, rnd.randint(0, 5), rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, x long, m double")
    # a deliberately skewed bucketing: most rows in the first bucket
    b = F.when(F.col("k") < 200, 0).otherwise(F.floor(F.col("k") / (100 / n_buckets)))
    got = prefix_scan(df.withColumn("bk", b), ["g"], "bk", F.col("k"), ["x"], neighbours=True, maxes=["m"])
    w = Window.partitionBy("g").orderBy("k")
    want = df.select(
        "g", "k",
        F.row_number().over(w).alias("idx"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.lag(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0))).over(w).alias("prev"),
        F.lead(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0))).over(w).alias("next"),
        F.max("m").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("mx"),
        F.max("m").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mxp"),
    )
    j = got.join(want, ["g", "k"])
    bad = j.filter((F.col("_idx") != F.col("idx")) | (F.col("x_cum") != F.col("cum"))
                   | ~F.col("x_cum_prev").eqNullSafe(F.col("prev")) | ~F.col("x_cum_next").eqNullSafe(F.col("next"))
                   | (F.col("m_cummax") != F.col("mx")) | ~F.col("m_cummax_prev").eqNullSafe(F.col("mxp")))
    assert j.count() == 300
    assert bad.count() == 0


def test_global_rank_quantile_buckets(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("v"), (F.col("id") % 2).alias("g"))
    r = global_rank(df, ["g"], F.col("v"), quantile_bucket(df, "v", 8))
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.row_number().over(w).alias("rn"))
    assert r.join(want, ["g", "v"]).filter(F.col("_idx") != F.col("rn")).count() == 0


def test_bounds_of_text_and_missing_values(spark):
    rows = [(f"t_{(i * 7919) % 400:04d}" if i % 10 else None,) for i in range(400)]
    df = spark.createDataFrame(rows, "v string")
    got = quantile_bucket(df, "v", 8)(df).orderBy("v").collect()
    filled = [r._bk for r in got if r.v is not None]
    assert filled == sorted(filled) and 6 <= len(set(filled)) <= 20
    assert {r._bk for r in got if r.v is None} == {None}
    empty = df.filter("v = 'none'")
    assert quantile_bucket(empty, "v", 8)(empty).collect() == []


def test_not_a_number_sorts_last_both_ways(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (2.0,)], "v double")
    up = quantile_bucket(df, "v", 4)(df).collect()
    down = quantile_bucket(df, "v", 4, descending=True)(df).collect()
    for rows in (up, down):
        assert max(rows, key=lambda r: r._bk).v != max(r.v for r in rows if r.v == r.v)


def test_cost_does_not_follow_the_bucket_count(spark):
    from screensift.operators import metrics as M

    sc = spark.range(60_000).select((F.xxhash64("id") / F.lit(2.0 ** 63)).alias("score"),
                                    (F.col("id") % 3 == 0).cast("int").alias("label"))
    auc, took = {}, {}
    for n in (32, 32, 4000):  # the first run warms up
        t = time.time()
        auc[n] = M.roc_auc(sc, n_buckets=n).first()["auc"]
        took[n] = time.time() - t
    assert abs(auc[32] - auc[4000]) < 1e-12
    assert took[4000] < 3 * took[32] + 2
