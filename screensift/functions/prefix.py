"""Exact global running totals without a single-partition window.

``Window.orderBy(..)`` with no partition key moves every row into one task. The
scan below splits the order into buckets (any monotone bucketing is correct,
only the balance depends on it), runs the window inside each bucket, and adds
the totals of all earlier buckets from a small per-bucket summary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_buckets(df: DataFrame, per_partition: int = 4, minimum: int = 16) -> int:
    """Buckets for a scan of ``df``: a few per shuffle partition, so they grow with the cluster."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(minimum, per_partition * parts)


#: Rows sampled per bucket to place the bounds; more rows only even the buckets out.
SAMPLE_PER_BUCKET = 32


def sorted_bounds(df: DataFrame, col: str, n_buckets: int, by: Sequence[str] = ()) -> Column:
    """About ``n_buckets - 1`` increasing bounds of ``col`` as a scalar subquery.

    The bounds are every k-th value of a sample of about
    ``SAMPLE_PER_BUCKET * n_buckets`` rows, taken by the hash of ``by`` (the
    columns that tell rows apart; default ``col``). The sample decides only where
    buckets end; every row is placed. Its size follows the bucket count, not the
    rows, so the one task that sorts it stays small at any input size.
    """
    keys = list(dict.fromkeys([*by, col]))
    values = df.select(*keys).filter(F.col(col).isNotNull())
    size = values.select(F.count(F.lit(1))).scalar()
    every = F.greatest(F.lit(1).cast("bigint"), F.floor(size / F.lit(SAMPLE_PER_BUCKET * n_buckets)))
    sample = values.filter(F.pmod(F.xxhash64(*keys), every) == 0)
    step = F.greatest(F.lit(1), F.floor(F.size("s") / F.lit(n_buckets)))
    return sample.select(F.sort_array(F.collect_set(col)).alias("s")).select(
        F.filter("s", lambda x, i: F.pmod(i + 1, step) == 0).alias("b")).scalar()


def quantile_bucket(df: DataFrame, col: str, n_buckets: int, descending: bool = False,
                    by: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``_bk``, monotone in ``col``: the number of sampled bounds
    of ``df`` below a row's value, found by bisection.

    A row takes about log2(n_buckets) comparisons whatever the bucket count.
    Equal values always share a bucket; NULL has the NULL bucket.
    """
    bounds = sorted_bounds(df, col, n_buckets, by)
    # the sample's size varies, so there may be up to twice as many bounds as asked for
    steps = [1 << e for e in reversed(range((4 * n_buckets).bit_length()))]
    x = F.col(col)
    pos = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when(F.get("_bounds", at + s - 1) < x, at + s).otherwise(at))
    if descending:
        pos = -pos
        if dict(df.dtypes)[col] in ("double", "float"):
            pos = F.when(F.isnan(col), F.lit(1)).otherwise(pos)  # -NaN still sorts last

    def add(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bounds", bounds).withColumn("_bk", F.when(x.isNotNull(), pos)).drop("_bounds")

    return add


def hex_bucket(hex_col: Column, n_buckets: int) -> Column:
    """Bucket by the leading 24 bits of a hash in hex; uniform without sampling."""
    return F.floor(F.conv(F.substring(hex_col, 1, 6), 16, 10).cast("bigint") * n_buckets / (1 << 24)).cast("int")


def prefix_scan(
    df: DataFrame,
    partition_by: Sequence[str],
    bucket: str,
    order_key: Column,
    sums: Sequence[str],
    neighbours: bool = False,
    maxes: Sequence[str] = (),
) -> DataFrame:
    """Add running totals in ``order_key`` order within each ``partition_by`` group.

    ``df[bucket]`` must be non-decreasing along ``order_key`` inside a group and
    ``order_key`` should be unique inside a group. Adds ``_idx`` (1-based
    position), ``_n`` (rows in the group), ``<c>_cum`` and ``<c>_total`` for
    every ``c`` in ``sums`` and, with ``neighbours``, ``<c>_cum_prev`` / ``<c>_cum_next`` (the
    running total at the previous / next row, NULL at the ends).
    """
    parts = list(partition_by)
    keys = parts + [bucket]
    w = Window.partitionBy(*keys).orderBy(order_key)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = df.withColumn("_rn", F.row_number().over(w))
    for c in sums:
        local = local.withColumn(f"_lc_{c}", F.sum(c).over(upto))
    if neighbours:
        for c in sums:
            local = local.withColumn(f"_ln_{c}", F.lead(f"_lc_{c}").over(w))
            local = local.withColumn(f"_lp_{c}", F.lag(f"_lc_{c}").over(w))
    for c in maxes:
        local = local.withColumn(f"_lm_{c}", F.max(c).over(upto))
        local = local.withColumn(f"_lmp_{c}", F.lag(f"_lm_{c}").over(w))

    # Per-bucket summary from the windowed rows themselves: they are already
    # clustered by (partition_by, bucket), so this aggregate needs no exchange
    # and the input is not scanned a second time.
    aggs = [F.max("_rn").alias("_bn")]
    for c in sums:
        aggs.append(F.max_by(f"_lc_{c}", "_rn").alias(f"_bs_{c}"))
        if neighbours:
            aggs.append(F.min_by(F.col(c), "_rn").alias(f"_bf_{c}"))
    for c in maxes:
        aggs.append(F.max_by(f"_lm_{c}", "_rn").alias(f"_bm_{c}"))
    summary = local.groupBy(*keys).agg(*aggs)

    ws = (Window.partitionBy(*parts) if parts else Window).orderBy(bucket)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    cols = [
        *keys,
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"),
        F.sum("_bn").over(whole).alias("_n"),
    ]
    for c in sums:
        off = F.coalesce(F.sum(f"_bs_{c}").over(before), F.lit(0))
        cols.append(off.alias(f"_oc_{c}"))
        cols.append(F.sum(f"_bs_{c}").over(whole).alias(f"{c}_total"))
        if neighbours:
            cols.append((off + F.col(f"_bs_{c}") + F.lead(f"_bf_{c}").over(ws)).alias(f"_nf_{c}"))
    for c in maxes:
        cols.append(F.max(f"_bm_{c}").over(before).alias(f"_om_{c}"))
    summary = summary.select(*cols)

    # null-safe: rows of a NULL group, or of a NULL bucket (NULL order value), meet their own summary
    renamed = summary.withColumnsRenamed({k: f"_k_{i}" for i, k in enumerate(keys)})
    same = [local[k].eqNullSafe(renamed[f"_k_{i}"]) for i, k in enumerate(keys)]
    out = local.join(renamed, on=same, how="inner").drop(*[f"_k_{i}" for i in range(len(keys))])
    out = out.withColumn("_idx", F.col("_rn") + F.col("_on"))
    for c in sums:
        out = out.withColumn(f"{c}_cum", F.col(f"_lc_{c}") + F.col(f"_oc_{c}"))
        if neighbours:
            out = out.withColumn(
                f"{c}_cum_prev",
                F.when(F.col("_rn") > 1, F.col(f"_lp_{c}") + F.col(f"_oc_{c}"))
                .when(F.col("_on") > 0, F.col(f"_oc_{c}")),
            )
            out = out.withColumn(
                f"{c}_cum_next",
                F.coalesce(F.col(f"_ln_{c}") + F.col(f"_oc_{c}"), F.col(f"_nf_{c}")),
            )
    for c in maxes:
        out = out.withColumn(f"{c}_cummax", F.greatest(F.col(f"_lm_{c}"), F.col(f"_om_{c}")))
        out = out.withColumn(f"{c}_cummax_prev", F.greatest(F.col(f"_lmp_{c}"), F.col(f"_om_{c}")))
    drop = ["_rn", "_on"] + [f"_lc_{c}" for c in sums] + [f"_oc_{c}" for c in sums]
    drop += [f"_{p}_{c}" for c in maxes for p in ("lm", "lmp", "om")]
    if neighbours:
        drop += [f"_ln_{c}" for c in sums] + [f"_lp_{c}" for c in sums] + [f"_nf_{c}" for c in sums]
    return out.drop(*drop)


def global_rank(df: DataFrame, partition_by: Sequence[str], order_key: Column,
                bucket: Column | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """1-based row number by ``order_key`` within ``partition_by`` (adds ``_idx``, ``_n``)."""
    tmp = df.withColumn("_bk", bucket) if isinstance(bucket, Column) else bucket(df)
    tmp = tmp.withColumn("_one", F.lit(1))
    return prefix_scan(tmp, partition_by, "_bk", order_key, ["_one"]).drop(
        "_bk", "_one", "_one_cum", "_one_total")
