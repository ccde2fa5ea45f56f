"""Benchmark decontamination with a generalised suffix automaton (operator 8).

The normalised benchmark items build one automaton over words. Training
documents stream through it; the state carries the length of the longest word
run that ends here and occurs in some item. A run of ``window`` words or more (or a
whole item, if the item is shorter) is a hit, and the items behind it are read
from the automaton state. Documents never shuffle; the automaton is broadcast
in shards of at most ``shard_words`` item words, one after the other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.llm.frames import chunks, materialise, packed, text_of, unpacked

WINDOW = 13
#: A document is contaminated when hits make up 1 / COVERAGE of its words or more.
COVERAGE = 20
#: Bound of one broadcast automaton (two states a word at most, about 1 kB a word).
SHARD_WORDS = 200_000

#: Bytes to words: A-Z to lower case; all other ASCII but digits and letters separates; the rest belongs to words.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _word_spans(text: str) -> list[tuple[int, int]]:
    """Code point (start, end) of every word of ``words_of(text)``."""
    spans, start = [], -1
    for i, c in enumerate(text):
        if ord(c) >= 128 or (c.isalnum()):
            if start < 0:
                start = i
        elif start >= 0:
            spans.append((start, i))
            start = -1
    if start >= 0:
        spans.append((start, len(text)))
    return spans


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences (items), with item sets per window."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        sequences = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text or "")]
            if ids:
                sequences.append((item_id, ids))
                self._add(ids)
        # items by the state that holds a window of theirs, and short items by their own state
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item_id, ids in sequences:
            state = length = 0
            for w in ids:
                state, length = self._next(state, length, w)
                if length >= window:
                    self.items.setdefault(self._shorten(state, window), set()).add(item_id)
            if len(ids) < window:
                entry = self.short.setdefault(state, [])
                if (len(ids), item_id) not in entry:
                    entry.append((len(ids), item_id))
        # a state inherits the short items of its suffixes (links point to shorter states)
        if self.short:
            for v in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                if up := self.short.get(self.link[v]):
                    self.short[v] = up + self.short.get(v, [])

    def _add(self, ids: list[int]) -> None:
        last = 0
        for w in ids:
            if (q := self.step[last].get(w)) is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
                continue
            cur = self._state(self.length[last] + 1, {})
            p = last
            while p >= 0 and w not in self.step[p]:
                self.step[p][w] = cur
                p = self.link[p]
            if p < 0:
                self.link[cur] = 0
            else:
                q = self.step[p][w]
                self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
            last = cur

    def _state(self, length: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(-1)
        self.step.append(step)
        return len(self.length) - 1

    def _clone(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.step[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _next(self, state: int, length: int, w: int) -> tuple[int, int]:
        step = self.step
        while (to := step[state].get(w)) is None:
            if state == 0:
                return 0, 0
            state = self.link[state]
            length = self.length[state]
        return to, length + 1

    def _shorten(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans [start, end) covered by hits, and the items hit."""
        window, short, link, lengths, step = self.window, self.short, self.link, self.length, self.step
        get = self.vocabulary.get
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        seen: set[int] = set()
        state = length = 0
        for i, w in enumerate([get(x, -1) for x in words]):
            if w < 0:
                state = length = 0
                continue
            while (to := step[state].get(w)) is None and state:
                state = link[state]
                length = lengths[state]
            if to is None:
                continue
            state, length = to, length + 1
            start = -1
            if length >= window:
                start = i + 1 - window
                at = self._shorten(state, window)
                if at not in seen:
                    seen.add(at)
                    found |= self.items[at]
            if short and (entry := short.get(state)):
                for n, item in entry:
                    if n <= length:
                        found.add(item)
                        start = min(start, i + 1 - n) if start >= 0 else i + 1 - n
            if start >= 0:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, found


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


class _Shards:
    """Items in shards of about ``shard_words`` words each, one in the driver at a time, so no broadcast grows with the benchmark."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, shard_words: int):
        items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"),
                                 text_of(f"`{text_col}`").alias("text")).distinct()
        size = items.agg(F.sum(F.length("text"))).first()[0] or 0
        self.n = max(1, -(-size // (4 * shard_words)))  # four characters a word and more
        self.dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(self.n)))

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[list[tuple[str, str]]]:
        for i in range(self.n):
            yield [(r.item, r.text) for r in self.dealt.where(F.col("shard") == i).select("item", "text").toLocalIterator()]


def scanned(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(row, text, n_words, spans, items): what each document shares with the benchmark.

    ``spans`` are merged word ranges [start, end) flattened in order, ``items``
    the ids of items with a window in the document. NULL texts have no words;
    items without words, and an empty benchmark, hit nothing; a NULL item id
    reads 'null'; repeated items count once.
    """
    spark = docs.sparkSession
    out = packed(docs, text=text_of(f"`{text_col}`"), n_words=F.lit(0).cast("bigint"),
                 spans=F.array().cast("array<int>"), items=F.array().cast("array<string>"))
    shards = _Shards(benchmark, item_col, item_text_col, shard_words)
    for i, items in enumerate(shards):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(items, window))
        out = out.mapInArrow(_scanner(shared), out.schema)
        if i + 1 < len(shards):  # written in between, so that a task never holds two automata
            out = materialise(out, "benchmark-shard")
            shared.unpersist()
    return out


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for b in chunks(batches, "text"):
            n_words, spans, items = [], [], []
            for text, old, known in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "items"))):
                words = words_of(text)
                hits, found = automaton.scan(words)
                if old:
                    hits = _merged(hits + list(zip(old[::2], old[1::2])))
                n_words.append(len(words))
                spans.append([x for s in hits for x in s])
                items.append(sorted(found.union(known)))
            cols = {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32())),
                    "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([cols.get(n, b.column(i)) for i, n in enumerate(b.schema.names)],
                                             b.schema.names)
    return run


def _n_hit() -> Column:
    """Words inside spans: ends minus starts."""
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("bigint"))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE,
                  **columns) -> DataFrame:
    """Input columns plus n_words, n_hit, items (sorted ids) and contaminated, one row per input row."""
    seen = scanned(docs, benchmark, window=window, **columns).withColumn("n_hit", _n_hit())
    over = (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))
    return unpacked(seen, n_words=F.col("n_words"), n_hit=F.col("n_hit"), items=F.col("items"), contaminated=over)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                  coverage: int = COVERAGE, **columns) -> DataFrame:
    """Filter: documents over the coverage limit go, shorter hit spans are cut out of the others' text.

    Documents without a hit keep their text to the byte. An ``n_chars`` column,
    if there is one, follows a cut.
    """
    seen = scanned(docs, benchmark, text_col=text_col, window=window, **columns).withColumn("n_hit", _n_hit())
    kept = seen.where((F.col("n_hit") == 0) | (coverage * F.col("n_hit") < F.col("n_words")))

    @F.pandas_udf("string")
    def cut(text, spans):
        out = []
        for t, s in zip(text, spans):
            if len(s):
                places, parts, at = _word_spans(t), [], 0
                for a, e in zip(s[::2], s[1::2]):
                    parts.append(t[at:places[a][0]])
                    at = places[e - 1][1]
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pd.Series(out)

    clean = kept.withColumn("text", F.when(F.col("n_hit") == 0, F.col(f"row.`{text_col}`")).otherwise(
        cut(F.when(F.col("n_hit") > 0, F.col("text")).otherwise(F.lit("")), F.when(F.col("n_hit") > 0, F.col("spans")).otherwise(F.array().cast("array<int>")))))
    changed = {text_col: F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_hit") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return clean.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
