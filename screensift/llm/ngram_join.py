"""N-gram Jaccard self-join by parity sketches (operator 13).

A document is the set of its distinct word shingles, each hashed to 64 bits.
Hashing the set into blocks and XOR-ing the tokens of a block gives a parity
sketch: equal tokens cancel, so sketches of two sets differ in at most as many
places as the sets' symmetric difference has elements. Jaccard similarity s
allows a difference of (1 - s) / (1 + s) of the two sizes together, so within a
band of sizes at most D places differ, and of more than D blocks one is equal
(pigeonhole). A block is kept as the XOR of its tokens' 64-bit hashes.

Every document sends the D + 1 richest blocks of a band's sketch. Richness
depends on a block's content only, so of two linked documents the one with the
higher bar has D + 1 blocks above the other's, one of which is equal: no link is
lost. Rich means many tokens that are not frequent in the corpus (frequent ones
come from a mergeable Misra-Gries summary of all documents, of bounded size), so
a passage that a third of the documents share fills no blocks as long as the
documents have words of their own.

Candidates are verified on the whole sets. A star round joins every document of
a block to its first one, which settles groups of copies with as many pairs as
documents. Then, among documents of a block that are still in different
components, each meets its nearest ones by dense parity sketches (whose distance
is never more than the sets'), one first, and more in every
further round over the blocks that have more; the rounds end when every
candidate between different components has been verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screensift.llm.components import components
from screensift.llm.frames import chunks, materialise, shuffle_partitions, text_of

SHINGLE_WORDS, SHARE = 5, 80
#: Counters of the frequent-token summary; every token on more than 1/COUNTERS of all token places is found.
COUNTERS = 1 << 16
#: A token of the summary on so many documents is frequent.
FREQUENT = 64
#: Texts of one task whose sets were already sent (only saves rows).
SEEN = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def _hashes(w: np.ndarray, width: int) -> np.ndarray:
    """One hash for each ``width`` consecutive word hashes."""
    h = np.full(max(0, len(w) - width + 1), width, np.uint64)
    for i in range(width):
        h = mixed(h + w[i:len(w) - width + 1 + i] * _ODD)
    return h


def shingle_sets(texts: list[str | None], words_each: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its lower-cased (A-Z) word shingles; fewer words: the whole sequence; none: empty."""
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes: ASCII case and white space only
    start = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, int(start[-1]))
    every, out = _hashes(w, words_each), []
    for lo, hi in zip(start[:-1], start[1:]):
        if hi - lo >= words_each:
            h = np.sort(every[lo:hi - words_each + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        else:
            out.append(_hashes(w[lo:hi], int(hi - lo)) if hi > lo else w[:0])
    return out


def set_digest(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes())


class Bands:
    """Size bands a factor of 1.5 apart and the sketch of each: its blocks and how many of them may differ.

    A document meets partners of its own band and, where 100 / share times its
    size reaches there, of the next; the sketch of a band serves both.
    """

    def __init__(self, share: int = SHARE):
        if not 67 <= share < 100:
            raise ValueError("share must be between 67 and 99")
        self.share, self.start = share, [1]

    def band(self, size: int) -> int:
        while self.start[-1] <= size:
            self.start.append(self.start[-1] * 3 // 2 + 1)
        return int(np.searchsorted(self.start, size, "right")) - 1

    def most(self, size: int) -> int:
        """The largest set that a set of this size can link with."""
        return size * 100 // self.share

    def differing(self, band: int) -> int:
        """The largest symmetric difference of a linked pair whose smaller set lies in the band."""
        self.band(self.start[-1] if band + 1 >= len(self.start) else 1)
        largest = self.start[band + 1] - 1
        return (100 - self.share) * (largest + self.most(largest)) // (100 + self.share)

    def sketches(self, size: int) -> list[int]:
        """The bands under which a set of this size sends blocks."""
        own = self.band(size)
        below = [own - 1] if own and size <= self.most(self.start[own] - 1) else []
        return [b for b in [own, *below] if self.differing(b)]  # no difference allowed: equal sets only


def n_blocks(differing: np.ndarray) -> np.ndarray:
    return np.maximum(-(-(differing + 1) * 5 // 4), differing + 4)


def block_keys(tokens: np.ndarray, light: np.ndarray, size: np.ndarray, band: np.ndarray, differing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of the ``differing + 1`` richest blocks of each set's sketch in its ``band``.

    ``tokens`` and ``light`` (not frequent) of all sets one after the other, ``size`` tokens each.
    """
    blocks, owner = n_blocks(differing), np.repeat(np.arange(len(size)), size)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype(np.int64)
    place = first[owner] + (mixed(tokens ^ band.astype(np.uint64)[owner]) % blocks.astype(np.uint64)[owner]).astype(np.int64)
    total = int(blocks.sum())
    parity = np.zeros(total, np.uint64)
    np.bitwise_xor.at(parity, place, tokens)
    rich = (np.bincount(place, minlength=total) > 0) + 2 * np.bincount(place, light, total).astype(np.int64)
    of = np.repeat(np.arange(len(size)), blocks)
    at = (np.arange(total) - first[of]).astype(np.uint64) | (band.astype(np.uint64)[of] << np.uint64(48))
    key = mixed(parity + mixed(at))
    # the order within a set is by richness, then by key: both follow from the block's content alone
    order = np.lexsort((key, rich, of))
    left = np.repeat(np.cumsum(blocks), blocks) - np.arange(total)  # blocks of the set from here on, in that order
    chosen = order[left <= (differing + 1)[of]]
    return of[chosen], key[chosen]


class Frequent:
    """Misra-Gries summary of 64-bit tokens in numpy: at most ``counters`` tokens stay, merged by adding counts."""

    def __init__(self, counters: int = COUNTERS):
        self.counters = counters
        self.token, self.count = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.fresh, self.size = [], 0

    def add(self, tokens: np.ndarray) -> None:
        self.fresh.append(tokens)
        self.size += len(tokens)
        if self.size >= 8 * self.counters:
            self.settle()

    def settle(self) -> None:
        token, count = np.unique(np.concatenate(self.fresh or [self.token[:0]]), return_counts=True)
        every = np.concatenate([self.token, token])
        self.token, at = np.unique(every, return_inverse=True)
        self.count = np.bincount(at, np.concatenate([self.count, count]), len(self.token)).astype(np.int64)
        self.fresh, self.size = [], 0
        if len(self.token) > self.counters:
            self.count -= np.partition(self.count, -self.counters - 1)[-self.counters - 1]
            stay = self.count > 0
            self.token, self.count = self.token[stay], self.count[stay]


def _long(tokens: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(tokens).view(np.int64))


def _sets(docs: DataFrame, words_each: int, counters: int) -> DataFrame:
    """(id, text, print) -> rows (id, print, n, rep) of every document and, from the same pass, rows (token, seen) of frequent tokens."""
    id_type, names = docs.schema["id"].dataType.simpleString(), ["id", "print", "n", "rep", "token", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(counters)
        for b in chunks(batches, "text"):
            sizes, reps = [], []
            for tokens in shingle_sets(b.column("text").to_pylist(), words_each):
                frequent.add(tokens)
                sizes.append(len(tokens))
                reps.append(set_digest(tokens))
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("print"), pa.array(sizes, pa.int64()), _long(np.array(reps, np.uint64)), none, none],
                                             names)
        frequent.settle()
        more = frequent.count > 1
        if more.any():
            token, count = frequent.token[more], frequent.count[more]
            none = pa.nulls(len(token), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(token), b.schema.field("id").type), none, none, none, _long(token), pa.array(count)],
                                             names)

    return docs.select("id", "print", "text").mapInArrow(run, f"id {id_type}, print bigint, n bigint, rep bigint, token bigint, seen bigint")


def _blocks(docs: DataFrame, frequent: np.ndarray, share: int, words_each: int) -> DataFrame:
    """(text) -> (key, rep): the blocks of every distinct set (of a set's copies in one task one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(share), set()
        for b in chunks(batches, "text"):
            sets, reps, band = [], [], []
            for tokens in shingle_sets(b.column(0).to_pylist(), words_each):
                rep = set_digest(tokens)
                if not len(tokens) or rep in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(rep)
                for k in bands.sketches(len(tokens)):
                    sets.append(tokens)
                    reps.append(rep)
                    band.append(k)
            if not sets:
                continue
            tokens = np.concatenate(sets)
            light = np.ones(len(tokens), bool)
            if len(frequent):
                light = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] != tokens
            of, key = block_keys(tokens, light, np.array([len(t) for t in sets]), np.array(band), np.array([bands.differing(k) for k in band]))
            yield pa.RecordBatch.from_arrays([_long(key), _long(np.array(reps, np.uint64)[of])], ["key", "rep"])

    return docs.select("text").mapInArrow(run, "key bigint, rep bigint")


def _shared(blocks: DataFrame) -> DataFrame:
    """(key, rep) -> (key, rep, least) of the keys with several reps, ``least`` the key's first; a sorted stream, O(1) memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, rep, least of the last row, and whether it was sent
        for batch in batches:
            key, rep = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sent = np.zeros(len(key), bool)
            if last is not None:
                key, rep = np.concatenate([last[0], key]), np.concatenate([last[1], rep])
                sent = np.concatenate([last[3], sent])
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (rep[1:] != rep[:-1])
            key, rep, sent = key[new], rep[new], sent[new]
            joins = key[1:] == key[:-1]
            start = np.concatenate([[True], ~joins])
            least = rep[start][np.cumsum(start) - 1]
            if last is not None:
                least[np.cumsum(start) == 1] = last[2][0]
            with_next, with_last = np.append(joins, False), np.concatenate([[False], joins])
            with_last[0] |= sent[0]
            send = (with_next | with_last) & ~sent
            last = (key[-1:], rep[-1:], least[-1:], sent[-1:] | send[-1:])
            if send.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[send]) for c in (key, rep, least)], ["key", "rep", "least"])

    dealt = blocks.repartition(shuffle_partitions(blocks), "key").sortWithinPartitions("key", "rep")
    return dealt.mapInArrow(run, "key bigint, rep bigint, least bigint")


def dense_sketch(tokens: np.ndarray) -> bytes:
    """Parity sketch of a power of two of bits, 8 to 16 for each token (64 at least); folding its halves together gives the sketch of half the bits."""
    bits = max(64, 1 << (8 * len(tokens) - 1).bit_length())
    at = (mixed(tokens + _ODD) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches of any widths as rows of 64-bit words, all folded to the narrowest."""
    width = min(map(len, sketches))
    rows = [np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width // 8), axis=0) for s in sketches]
    return np.stack(rows)


def _involved(docs: DataFrame, sets: DataFrame, reps: DataFrame, words_each: int) -> DataFrame:
    """(rep, n, sketch, tokens) of the sets in ``reps``, from the whole text of one document of each."""
    one = sets.where("n > 0").groupBy("rep").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("doc"))
    one = one.join(reps, "rep", "left_semi").select(F.col("doc.id").alias("id_"), F.col("doc.print").alias("print_"))
    texts = docs.join(one, docs["id"].eqNullSafe(one["id_"]) & (docs["print"] == one["print_"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 1 << 20):
            found = shingle_sets(b.column(0).to_pylist(), words_each)
            yield pa.RecordBatch.from_arrays(
                [_long(np.array([set_digest(t) for t in found], np.uint64)), pa.array([len(t) for t in found], pa.int64()),
                 pa.array([dense_sketch(t) for t in found], pa.binary()), pa.array([t.view(np.int64) for t in found], pa.list_(pa.int64()))],
                ["rep", "n", "sketch", "tokens"])

    read = texts.select("text").mapInArrow(run, "rep bigint, n bigint, sketch binary, tokens array<bigint>")
    return read.join(reps, "rep", "left_semi").dropDuplicates(["rep"])


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Distinct pairs (a, b) of sets -> those that link, compared on their whole sets."""
    one, other = (sets.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}")) for c in "ab")
    both = F.size(F.array_intersect("ta", "tb")).cast("bigint")
    sized = pairs.join(sets.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
    sized = sized.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * share).select("a", "b")
    met = sized.join(one, "a").join(other, "b").withColumn("both", both)
    return met.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * share).select("a", "b")


#: Nearest candidates a member may have verified: one in the first round, so many times more in each further one.
ROUND_FACTOR = 64
#: Members of a block compared in one task; larger blocks are dealt into cells of two slices each.
CELL = 1 << 12


def _near_in_cells(members: DataFrame, share: int, keep: int) -> DataFrame:
    """(key, i, j, slice, rep, root, n, sketch) -> for each member its ``keep`` nearest of other roots whose sketches allow a link, as pairs (a, b);
    and a row (key) for each cell in which a member has more of them."""

    def compare(key, slices, rep, root, n, sketch) -> Iterator[pa.RecordBatch]:
        rep, root, n, slices = (np.array(x) for x in (rep, root, n, slices))
        words, halves, more = folded(sketch), slices.min() != slices.max(), False
        left, right = [], []
        for x in range(len(rep)):
            near = (root != root[x]) & (np.minimum(n, n[x]) * 100 >= np.maximum(n, n[x]) * share)
            if halves:
                near &= slices != slices[x]
            y = np.nonzero(near)[0]
            if not len(y):
                continue
            apart = np.bitwise_count(words[y] ^ words[x]).sum(1, dtype=np.int64)
            ok = apart * (100 + share) <= (n[y] + n[x]) * (100 - share)
            y, apart = y[ok], apart[ok]
            if len(y) > keep:
                more = True
                y = y[np.lexsort((rep[y], apart / (n[y] + n[x])))[:keep]]
            left.append(np.minimum(rep[y], rep[x]))
            right.append(np.maximum(rep[y], rep[x]))
        if left:
            a, b = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "key"])
        if more:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key], pa.int64())], ["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for *now, slice_, rep, root, n, sketch in zip(*(c.to_pylist() for c in batch.columns)):
                if now != cell:
                    if len(rows) > 1:
                        yield from compare(cell[0], *zip(*rows))
                    cell, rows = now, []
                rows.append((slice_, rep, root, n, sketch))
        if len(rows) > 1:
            yield from compare(cell[0], *zip(*rows))

    dealt = members.repartition(shuffle_partitions(members), "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    return dealt.select("key", "i", "j", "slice", "rep", "root", "n", "sketch").mapInArrow(run, "a bigint, b bigint, key bigint")


def _open_blocks(shared: DataFrame, roots: DataFrame, only: DataFrame | None) -> DataFrame:
    """(key, rep) -> (key, rep, root, members) of the blocks (of ``only``) whose members are not in one component yet, each set of members once."""
    rooted = shared.select("key", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rooted = materialise(rooted, "rooted-blocks")
    per_key = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members"),
                                        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).where("lo < hi")
    if only is not None:
        per_key = per_key.join(only, "key", "left_semi")
    keys = per_key.groupBy("members", "x", "y").agg(F.min("key").alias("key")).select("key", "members")
    return materialise(rooted.join(keys, "key"), "open-blocks")


def _candidates(blocks: DataFrame, sets: DataFrame, share: int, cell: int, keep: int) -> DataFrame:
    """Candidates between components, as ``_near_in_cells``; blocks of more than ``cell`` members are dealt into cells of two slices."""
    slices = F.ceil(F.col("members") / cell).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(2)), slices.cast("bigint")).cast("int")
    dealt = blocks.withColumn("slice", own).withColumn("other", F.explode(F.sequence(F.lit(0), slices - 1)))
    dealt = dealt.select("key", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"), "slice", "rep", "root")
    return _near_in_cells(dealt.join(sets.select("rep", "n", "sketch"), "rep"), share, keep)


def linked_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = SHINGLE_WORDS, share: int = SHARE,
                counters: int = COUNTERS, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """(sets, components): (id, n, rep) of every row, and (node, root) of the distinct sets that link to another one."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text")).withColumn("print", F.xxhash64("text"))
    found = materialise(_sets(rows, words_each, counters), "shingle-sets")
    sets = found.where("n is not null").select("id", "print", "n", "rep")
    frequent = found.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= FREQUENT)
    most = [r[0] for r in frequent.orderBy(F.desc("seen"), "token").limit(counters).collect()]  # bounded: ``counters`` tokens
    shared = materialise(_shared(_blocks(rows, np.sort(np.array(most, np.int64).view(np.uint64)), share, words_each)), "shared-blocks")
    members = materialise(_involved(rows, sets, shared.select("rep").distinct(), words_each), "sets-in-blocks")
    star = shared.where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    roots = components(materialise(_verified(star, members, share), "star-links"))
    blocks, keep, left = shared, 1, None
    while True:
        blocks = _open_blocks(blocks, roots, left)
        near = materialise(_candidates(blocks, members, share, cell, keep), "near-pairs")
        links = materialise(_verified(near.where("key is null").select("a", "b").distinct(), members, share), "near-links")
        if not links.isEmpty():
            roots = components(links.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))
        left = near.where("key is not null").select("key").distinct()
        if left.isEmpty():
            return sets, roots
        keep *= ROUND_FACTOR  # again over the blocks with members whose candidates were not all verified, between the components there are now


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = SHINGLE_WORDS, share: int = SHARE,
                       counters: int = COUNTERS, cell: int = CELL) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id (smallest id reachable by links, itself included).

    Two documents link when 100 * intersection >= ``share`` * union of their
    sets. NULL text is the empty text; a text without words has an empty set and
    links with nothing, not even its copies. Equal sets (copies, or texts that
    differ in case or white space only) are one set with all its documents. Rows
    repeated with one id keep one row each; a NULL id takes part but never names
    a component that has another id. An empty table gives an empty result.
    Sets are compared by 64-bit shingle hashes.
    """
    sets, linked = linked_sets(docs, id_col, text_col, words_each, share, counters, cell)
    least = sets.where("n > 0").groupBy("rep").agg(F.min("id").alias("least"))
    rooted = least.join(linked.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rooted = materialise(rooted, "rooted-sets")
    named = rooted.select("rep", "root").join(rooted.groupBy("root").agg(F.min("least").alias("least")), "root").drop("root")
    return sets.join(named, "rep", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("least")), F.col("id")).alias("component_id"))
