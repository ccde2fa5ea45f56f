"""SimHash near-duplicates found through anchor points of a covering code (operator 7).

A document's fingerprint has 64 bits; bit i is set when more than half of its
word-shingle hashes have bit i set. Two fingerprints link at ``max_bits`` (t)
or fewer differing bits. At most t // 2 of these differ in one of the two
32-bit halves, so per half every fingerprint goes to its home anchor (the code
word within covering radius) and to all anchors within covering radius plus
t // 2; whatever links shares the home anchor of one of the two. Per anchor, homes are
compared with all members, whole fingerprints, and only a spanning set of the
links found there leaves the task. Equal texts collapse to one fingerprint
before any of this, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screensift.llm.components import components
from screensift.llm.covering import AnchorCode
from screensift.llm.frames import chunks, materialise, packed, shuffle_partitions, text_of, unpacked

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
#: An anchor with more members than this is split by the anchors of the other half.
HOT_MEMBERS = 1 << 16
#: Comparisons done at a time (bounds a task's memory).
STEP = 1 << 22


def text_fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the lower-cased (A-Z) word shingles; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle_words:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle_words)))]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(.., text) -> the other columns plus ``fp`` BIGINT (bit pattern of the fingerprint); NULL text: 0."""
    others = [f for f in df.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            fps = np.array([text_fingerprint(t or "", shingle_words) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in others] + [pa.array(fps.view(np.int64))], [f.name for f in others] + ["fp"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return df.select(*[f.name for f in others], "text").mapInArrow(run, f"{fields}, fp bigint")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _members(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp) -> (half, anchor, fp, home): every anchor within reach, per 32-bit half."""
    excess = max_bits // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = AnchorCode(excess)
        for big in batches:
            for at in range(0, big.num_rows, 1 << 13):
                fp = big.column(0).slice(at, 1 << 13).to_numpy(zero_copy_only=False).view(np.uint64)
                for half in (0, 1):
                    words = (fp >> np.uint64(32 * half)).astype(np.uint32)
                    row, anchor, home = code.anchors(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), half, np.int32)), pa.array(anchor.astype(np.int64)),
                         pa.array(fp[row].view(np.int64)), pa.array(home)], ["half", "anchor", "fp", "home"])

    return fps.mapInArrow(run, "half int, anchor bigint, fp bigint, home boolean")


def _split_hot(hot: DataFrame, max_bits: int) -> DataFrame:
    """Members of hot anchors, dealt again by the anchors of the other half (all t bits may differ there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = AnchorCode(max_bits)
        for big in batches:
            for at in range(0, big.num_rows, 1 << 10):
                b = big.slice(at, 1 << 10)
                half, first, home = (b.column(n).to_numpy(zero_copy_only=False) for n in ("half", "anchor", "home"))
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                words = (fp >> (np.uint64(32) * (1 - half).astype(np.uint64))).astype(np.uint32)
                row, anchor, near = code.anchors(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((half[row] + 2).astype(np.int32)), pa.array(first[row] | (anchor.astype(np.int64) << 32)),
                     pa.array(fp[row].view(np.int64)), pa.array(home[row] & near)], ["half", "anchor", "fp", "home"])

    return hot.mapInArrow(run, "half int, anchor bigint, fp bigint, home boolean")


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable over the links (a, b), by repeated hooking and pointer jumping."""
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label[label], label):
            label = label[label]


def _link_group(fp: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Labels within one large anchor group: breadth-first over the rows not yet reached, O(rows) memory."""
    label = np.arange(len(fp))
    left = np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        root = queue[0]
        while queue and len(left):
            at = queue.pop()
            ok = np.bitwise_count(fp[left] ^ fp[at]) <= max_bits
            if not home[at]:
                ok &= home[left]
            found, left = left[ok], left[~ok]
            label[found] = root
            queue.extend(found)
    return label


def _links(members: DataFrame, max_bits: int) -> DataFrame:
    """Compare per anchor: (half, anchor, fp, home) -> spanning links (a, b) of every anchor's members."""

    def settle(start: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``start``: first row of each group, and the number of rows."""
        size = np.diff(start)
        homes = np.add.reduceat(home.astype(np.int64), start[:-1]) if len(size) else size
        large = homes * size > STEP
        label = np.arange(len(fp))
        for g in np.nonzero(large)[0]:
            s = slice(start[g], start[g + 1])
            label[s] = start[g] + _link_group(fp[s], home[s], max_bits)
        group = np.repeat(np.arange(len(size)), size)
        h = np.nonzero(home & ~large[group] & (size[group] > 1))[0]  # rows at home, compared with their whole group
        width = size[group[h]]
        done, left, right = 0, [], []
        edge = np.concatenate([[0], np.cumsum(width)])
        while done < len(h):
            upto = max(done + 1, int(np.searchsorted(edge, edge[done] + STEP, "right")) - 1)
            w = width[done:upto]
            a = np.repeat(h[done:upto], w)
            b = np.repeat(start[group[h[done:upto]]] - (edge[done:upto] - edge[done]), w) + np.arange(w.sum())
            ok = (a != b) & (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits)
            left.append(a[ok])
            right.append(b[ok])
            done = upto
        if left:
            label = _settle(label, np.concatenate(left), np.concatenate(right))
        rows = np.nonzero(label != np.arange(len(label)))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[rows].view(np.int64)), pa.array(fp[label[rows]].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last group, which may go on in the next batch
        for batch in batches:
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("half", "anchor", "fp", "home")]
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols)]
            half, anchor, fp, home = cols
            new = np.nonzero((half[1:] != half[:-1]) | (anchor[1:] != anchor[:-1]))[0] + 1
            if len(new):
                start = np.concatenate([[0], new])
                yield from settle(start, fp[:new[-1]].view(np.uint64), home[:new[-1]].astype(bool))
                cols = [c[new[-1]:] for c in cols]
            rest = cols
        if rest is not None and len(rest[0]):
            yield from settle(np.array([0, len(rest[0])]), rest[2].view(np.uint64), rest[3].astype(bool))

    dealt = members.repartition(shuffle_partitions(members), "half", "anchor").sortWithinPartitions("half", "anchor")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Distinct (fp) -> (node, root) of every fingerprint that links to another one."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    members = materialise(_members(fps, max_bits), "anchors")
    hot = members.groupBy("half", "anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot_members).drop("n")
    hot = materialise(hot, "hot-anchors")
    if hot.isEmpty():
        return components(_links(members, max_bits))
    cool = members.join(hot, ["half", "anchor"], "left_anti")
    split = _split_hot(members.join(hot, ["half", "anchor"], "left_semi"), max_bits)
    return components(_links(cool, max_bits).union(_links(split, max_bits)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``id_col``, fingerprint, component_id (smallest id reachable, itself included).

    NULL text is the empty text; texts without words have fingerprint zero and
    link like any other. Rows repeated with one id keep one row each, all in
    the same component if their texts link. A NULL id takes part but never
    names a component that has another id; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"))
    prints = materialise(with_fingerprint(rows, shingle_words), "fingerprints")
    classes = _classes(prints.groupBy("fp").agg(F.min("id").alias("least")), max_bits)
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col), fingerprint_hex(F.col("fp")).alias("fingerprint"), F.col("least").alias("component_id"))


def _classes(least: DataFrame, max_bits: int) -> DataFrame:
    """Distinct (fp, least) -> (fp, least over the component)."""
    least = materialise(least, "distinct-fingerprints")
    linked = fingerprint_components(least.select("fp"), max_bits)
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    rooted = materialise(rooted, "rooted-fingerprints")
    return rooted.select("fp", "root").join(rooted.groupBy("root").agg(F.min("least").alias("least")), "root").drop("root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Filter: of each component only the row with the smallest id stays, all its columns unchanged.

    Ties on the id (repeated rows) keep the smallest text hash, of identical
    rows one; a NULL id stays only in a component without any other id.
    """
    key = [F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.xxhash64(text_of(f"`{text_col}`"))]
    own = docs.select(F.struct(key[0].alias("none"), key[1].alias("id"), key[2].alias("hash")).alias("id"),
                      text_of(f"`{text_col}`").alias("text"))
    prints = materialise(with_fingerprint(own, shingle_words), "fingerprints")
    winners = _classes(prints.groupBy("fp").agg(F.min("id").alias("least")), max_bits).select("least").distinct().select(
        F.col("least.none").alias("none"), F.coalesce(F.col("least.id").cast("string"), F.lit("")).alias("id"),
        F.col("least.hash").alias("hash"))
    own_key = {"none": key[0], "id": F.coalesce(key[1].cast("string"), F.lit("")), "hash": key[2]}
    kept = packed(docs, **own_key).join(winners, ["none", "id", "hash"], "left_semi")
    order = Window.partitionBy("none", "id", "hash").orderBy("none")
    return unpacked(kept.withColumn("nth", F.row_number().over(order)).where("nth = 1"))
