"""Mixing sources to target weights by weighted fair queueing (operator 9), JVM expressions only.

Every document of a source, in hash-shuffled order, gets the virtual finish
time (source words so far, its own included) / (target of the source). All
sources then reach their targets at virtual time 1, so ordering all documents
by finish time and cutting at the total budget mixes every source to its target.

Neither the running sums nor the global order use a window over a whole
source: documents are dealt into hash ranges (then finish-time ranges), the
sums run inside a range, and per-range totals give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screensift.llm.frames import materialise, packed, shuffle_partitions, text_of, unpacked

#: Contract values: weights in source order (repeating), share of all words, most repeats of a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source_key, size) -> one row per source: source_key, source_size, target.

    Targets share ``share`` of all words by weight; a target above ``most``
    times its source stops there and the excess is shared again. The fixed
    point is one level: sorted by limit / weight, the first source whose limit
    lies above the level of those left fixes the level for the rest.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source_key").asc_nulls_last()))
    ranked = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source_key").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", level).withColumn("open", F.col("ratio") > F.col("level"))
    shared = F.max(F.when(F.col("open"), F.col("level"))).over(whole)
    return levels.select("source_key", "source_size", F.when(F.col("open"), shared * F.col("weight")).otherwise(F.col("limit").cast("double")).alias("target"))


def _ranges(df: DataFrame) -> int:
    """Number of hash or time ranges: any number gives the same result."""
    return min(1 << 16, max(64, 4 * shuffle_partitions(df)))


def _timed(df: DataFrame, targets: DataFrame, slim: DataFrame, n: int) -> DataFrame:
    """Adds source_size, target and ``upto`` (source words up to and with this row) to (source_key, key, size, ..)."""
    def dealt(x: DataFrame) -> DataFrame:
        return x.withColumn("range", (F.conv(F.substring("key", 1, 4), 16, 10).cast("bigint") * n / 65536).cast("int"))

    per = dealt(slim).groupBy("source_key", "range").agg(F.sum("size").alias("in_range"))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.join(targets, "source_key").select(
        "source_key", "range", "source_size", "target", F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("before"))
    running = Window.partitionBy("source_key", "range").orderBy("key", "size")  # repeated rows share one place
    return dealt(df).join(offsets, ["source_key", "range"]).withColumn("upto", F.col("before") + F.sum("size").over(running)).drop("before", "range")


def _finish(epoch: int) -> Column:
    """Virtual finish time of the copy in ``epoch``; NULL where the row or its source has no words."""
    return F.when((F.col("size") > 0) & (F.col("target") > 0), (F.lit(epoch) * F.col("source_size") + F.col("upto")) / F.col("target"))


def _cut(timed: DataFrame, budget: Column, n: int, most: int) -> DataFrame:
    """One row (finish, key, epoch): the last copy whose words, with all before it, fit the budget."""
    copies = timed.select("size", "key", F.explode(F.array(*[F.struct(_finish(e).alias("finish"), F.lit(e).alias("epoch")) for e in range(most)])).alias("c")).select(
        "size", "key", "c.finish", "c.epoch").where("finish IS NOT NULL").withColumn("slot", F.least(F.floor(F.col("finish") * n), F.lit(2 * n)))
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    # at most 2 n + 1 rows, so broadcasting them is safe at any size of the input
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(slots.select("slot", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")))
    within = copies.join(starts, "slot").where(F.col("start") < budget)
    running = Window.partitionBy("slot").orderBy("finish", "key", "epoch")
    return within.withColumn("total", F.col("start") + F.sum("size").over(running)).where(F.col("total") <= budget).agg(
        F.max(F.struct("finish", "key", "epoch")).alias("last"))


def _mixed(df: DataFrame, slim: DataFrame, weights, share, most) -> DataFrame:
    """(.., source_key, key, size) plus source_size, target and ``taken``, an array of the epochs the mix takes."""
    n = _ranges(df)
    targets = materialise(source_targets(slim, weights, share, most), "targets")
    # targets add up to this (a sum of doubles would depend on its order)
    budget = targets.agg(F.lit(min(share, most)) * F.sum("source_size")).scalar()
    last = _cut(_timed(slim, targets, slim, n), budget, n, most).scalar()
    taken = F.filter(
        F.array(*[F.struct(_finish(e).alias("finish"), F.col("key").alias("key"), F.lit(e).alias("epoch")) for e in range(most)]),
        lambda c: c["finish"].isNotNull() & F.coalesce(c <= F.col("last"), F.lit(False)))
    return _timed(df, targets, slim, n).withColumn("last", last).withColumn("taken", taken).drop("last")


def _own(id_col: str, text_col: str, source_col: str, seed: str) -> dict[str, Column]:
    """Source key (by code point, NULL last), shuffle key and size of a row."""
    return {"source_key": F.coalesce(F.concat(F.lit("0"), F.col(f"`{source_col}`").cast("string")), F.lit("1")),
            "key": F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))),
            "size": word_count(text_of(f"`{text_col}`"))}


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per input row: ``id_col``, size, source_size, target, taken (words, repeats counted).

    NULL or empty texts have size 0 and are never taken; NULL sources are one
    source, last in order; repeated rows of one id stand at one place of the
    order and are taken or left together; an empty table gives an empty result.
    """
    own = _own(id_col, text_col, source_col, seed)
    slim = materialise(docs.select(F.col(f"`{id_col}`").alias("id"), *[c.alias(n) for n, c in own.items()]), "sizes")
    return _mixed(slim, slim, weights, share, most).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.size("taken") * F.col("size")).cast("bigint").alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: input columns plus mix_epoch and mix_time, one row per copy the mix takes."""
    own = _own(id_col, text_col, source_col, seed)
    slim = materialise(docs.select(F.col(f"`{id_col}`").alias("id"), *[c.alias(n) for n, c in own.items()]), "sizes")
    full = _mixed(packed(docs, **own), slim.drop("id"), weights, share, most)
    copies = full.withColumn("copy", F.explode("taken"))
    return unpacked(copies, mix_epoch=F.col("copy.epoch"), mix_time=F.col("copy.finish"))
