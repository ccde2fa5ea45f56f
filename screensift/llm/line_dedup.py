"""Line dedup by site-relative frequency (operator 3).

Per host, the share of pages that contain a line (normalised: white space
collapsed, lower case) tells boilerplate from content. Only 128-bit line
digests are grouped, once per page and pre-aggregated before the shuffle. The
lines to drop of a host with many pages are then repeated in as many parts as it
has thousandths of all pages, and its pages dealt to the parts by their hash,
so a line on every page of a host with a third of the corpus still meets them in
hundreds of groups; texts meet what they lose by (page, text hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.llm.frames import materialise, packed, text_of, unpacked

#: A line on more than this share of a host's pages is boilerplate, from so many pages of the host on.
MAX_RATIO, MIN_PAGES = 0.01, 3
#: A host's pages meet its dropped lines in parts of at most a so-many-th of all pages.
HOT_PARTS = 1000


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[ \t\x0B\f\r]+", " ")))


def _keys(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> dict[str, Column]:
    """Equal keys mean equal texts of one host, so repeated rows share a key harmlessly."""
    return {"page": F.coalesce(F.concat(F.lit("0"), F.col(f"`{id_col}`").cast("string")), F.lit("1")),
            "host": F.coalesce(F.concat(F.lit("0"), F.col(f"`{host_col}`").cast("string")), F.lit("1")),
            "hash": F.xxhash64(text_of(f"`{text_col}`")), "text": text_of(f"`{text_col}`")}


def boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, host_pages): digests of the lines to drop, per host."""
    rows = docs.select(*[c.alias(n) for n, c in _keys(docs, id_col, text_col, host_col).items()])
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), _normal))
    counts = rows.select("host", F.explode(lines).alias("line")).where("line <> ''").groupBy(
        "host", F.unhex(F.md5("line")).alias("line")).agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    totals = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    return counts.join(totals, "host").where(F.col("pages") / F.col("host_pages") > max_ratio)


def _in_parts(drops: DataFrame, docs: DataFrame) -> DataFrame:
    """(host, line, host_pages) -> (host, line, parts, part): every dropped line once for each part of its host."""
    pages = docs.select(F.count("*").alias("n")).scalar()
    parts = F.ceil(F.col("host_pages") / F.greatest(F.lit(1), F.ceil(pages / F.lit(HOT_PARTS))))
    drops = materialise(drops.select("host", "line", parts.cast("bigint").alias("parts")), "boilerplate")
    return drops.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """Input columns with boilerplate lines removed from the text; ``counts`` adds n_lines and n_dropped.

    Blank lines stay. NULL text stays NULL (0 lines); NULL hosts are one host;
    every input row is a page, repeated rows included. A line is dropped when
    it is on more than ``max_ratio`` of its host's pages and on at least
    ``min_pages``, so hosts with fewer pages keep everything. Texts without
    such lines stay to the byte, and an ``n_chars`` column follows a change.
    """
    drops = _in_parts(boilerplate(docs, id_col, text_col, host_col, max_ratio, min_pages), docs)
    # a host of several parts has over a HOT_PARTS-th of all pages, so there are fewer than HOT_PARTS of them
    hot = drops.where("parts > 1").select("host", "parts").distinct()
    keys = _keys(docs, id_col, text_col, host_col)
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.unhex(F.md5(_normal(x)))))
    dealt = docs.select(*[c.alias(n) for n, c in keys.items()]).join(F.broadcast(hot), "host", "left")
    part = F.pmod(F.xxhash64("page", "hash"), F.coalesce("parts", F.lit(1).cast("bigint"))).alias("part")
    found = dealt.select("page", "host", "hash", part, F.explode(lines).alias("line")).join(
        drops.select("host", "part", "line"), ["host", "part", "line"]).groupBy("page", "host", "hash").agg(F.collect_set("line").alias("drop"))
    split = F.split("text", "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("drop"), F.unhex(F.md5(_normal(x)))))
    out = packed(docs, **keys).join(found, ["page", "host", "hash"], "left")
    original = F.col(f"row.`{text_col}`")
    n_lines = F.when(original.isNull(), F.lit(0)).otherwise(F.size(split)).cast("bigint")
    out = out.withColumn("kept", F.when(F.col("drop").isNotNull(), kept))
    text = F.when(F.col("kept").isNull(), original).otherwise(F.array_join("kept", "\n"))
    changed = {text_col: text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    out = out.withColumn("n_dropped", F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.size(split) - F.size("kept")).cast("bigint"))
    extra = {"n_lines": n_lines, "n_dropped": F.col("n_dropped")} if counts else {}
    return unpacked(out.withColumn("row", F.struct(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])), **extra)
