"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 5).

Texts become code points (lower case, anything but letters read as one blank), and
every 1- to 3-gram hashes into one of 2^16 buckets, all in numpy over a batch of
texts at once. Training sums bucket counts per language; prediction gathers
the broadcast log-probability matrix at the batch's (text, bucket) entries and adds them up by
text, a sparse matrix product. Neither pass shuffles texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from screensift.llm.frames import chunks, packed, text_of, unpacked

BUCKETS, ORDERS, SMOOTHING = 1 << 16, (1, 2, 3), 0.5
#: About this many labelled documents train the model (all, if there are fewer), drawn by id hash and language:
#: every language has an equal part of them, and what small languages leave goes to the larger ones. A language has
#: at least MIN_PER_LANGUAGE rows (or all it has), also where many languages then exceed the total.
TRAINING_DOCS, MIN_PER_LANGUAGE = 30_000, 500
UNKNOWN = "und"
#: Characters of texts hashed at a time.
STRETCH = 1 << 18
#: Odd multipliers of the n-gram hash, one per order.
_FACTORS = {1: np.uint32(2654435761), 2: np.uint32(2246822519), 3: np.uint32(3266489917), 4: np.uint32(668265263)}



class _Fold(dict):
    """str.translate table, filled as characters turn up: letters stay, all else is a blank."""

    def __missing__(self, code: int) -> int:
        value = self[code] = code if chr(code).isalpha() else 32
        return value


def _buckets(codes: np.ndarray, owner: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of the n-grams that begin at one of the first ``starts`` characters."""
    blank = codes == 32
    rows, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in ORDERS:
        size = min(len(codes) - n + 1, starts)
        if size <= 0:
            continue
        h = np.zeros(size, np.uint32)
        for i in range(n):
            h = (h ^ codes[i:i + size]) * _FACTORS[n]
            h ^= h >> np.uint32(15)
        inner = ~blank[:size] if n == 1 else ~(blank[:size] & blank[1:size + 1])  # runs of blanks say nothing
        if n == 3:
            inner &= ~blank[1:size + 1]
        keep = np.nonzero(inner & (owner[:size] == owner[n - 1:n - 1 + size]))[0]
        rows.append(owner[keep])
        buckets.append((h[keep] & np.uint32(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngram_parts(texts: list[str], has: np.ndarray, fold: _Fold | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every n-gram of every text, in parts of about ``STRETCH`` characters; sets in ``has`` whether a text has a letter.

    A longer text is read in stretches that overlap by what an n-gram needs, so
    its n-grams are those of the whole text and memory does not follow its length.
    """
    fold = _Fold() if fold is None else fold
    group, numbers, size = [], [], 0

    def grouped() -> tuple[np.ndarray, np.ndarray]:
        return _buckets(_codes("".join(group)), np.repeat(np.array(numbers, np.int64), [len(c) for c in group]), size)

    for i, text in enumerate(texts):
        clean = f" {text.lower().translate(fold)} "  # every text has its own blank before and after
        has[i] = not clean.isspace()
        if len(clean) > STRETCH:
            for at in range(0, len(clean), STRETCH):
                codes = _codes(clean[at:at + STRETCH + max(ORDERS) - 1])
                yield _buckets(codes, np.full(len(codes), i, np.int64), STRETCH)
            continue
        if size + len(clean) > STRETCH:
            yield grouped()
            group, numbers, size = [], [], 0
        group.append(clean)
        numbers.append(i)
        size += len(clean)
    if group:
        yield grouped()


def ngram_buckets(texts: list[str], fold: _Fold | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of every text, and whether a text has a letter."""
    has = np.zeros(len(texts), bool)
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *ngram_parts(texts, has, fold)]
    return *(np.concatenate(p) for p in zip(*parts)), has


@dataclass
class Model:
    """Languages (sorted), log priors and the (language, bucket) log-probability matrix."""

    languages: list[str]
    prior: np.ndarray
    log_prob: np.ndarray

    def predict(self, texts: list[str], fold: _Fold | None = None) -> tuple[list[str], np.ndarray]:
        """Most likely language per text and its posterior; ``und`` (0.0) without letters or without a model."""
        if not self.languages or not len(texts):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        has, score = np.zeros(len(texts), bool), np.zeros((len(texts), len(self.languages)))
        for row, bucket in ngram_parts(texts, has, fold):
            for k, lp in enumerate(self.log_prob):
                score[:, k] += np.bincount(row, weights=lp[bucket], minlength=len(texts))
        score += self.prior
        best = score.argmax(1)
        posterior = 1.0 / np.exp(score - score.max(1, keepdims=True)).sum(1)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has)], np.where(has, posterior, 0.0))


def rows_each(docs: dict[str, int], max_docs: int, least: int = MIN_PER_LANGUAGE) -> int:
    """Rows a language may train with: the level at which the languages' rows, cut to it, make ``max_docs``; ``least`` at least."""
    left, sizes = max_docs, sorted(docs.values())
    for i, n in enumerate(sizes):
        if n * (len(sizes) - i) > left:
            return max(least, left // (len(sizes) - i))
        left -= n
    return max(least, sizes[-1]) if sizes else least


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_docs: int = TRAINING_DOCS,
          key: Column | None = None) -> Model:
    """Fit on labelled rows (NULL language: left out); about ``max_docs`` of them by hash of ``key`` (the text, if none).

    The draw is per language (see ``rows_each``), the priors are those of all rows. A language without a sampled
    n-gram (its rows may share one hash, or have no letters) is never predicted.
    """
    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), text_of(f"`{text_col}`").alias("text"),
        F.xxhash64(F.lit("train"), text_of(f"`{text_col}`") if key is None else key).alias("draw"))
    docs = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    total = sum(docs.values())
    if not total:
        return Model([], np.zeros(0), np.zeros((0, BUCKETS)))
    each = rows_each(docs, max_docs)
    bounds = {x: int((1 << 32) * each / n) for x, n in docs.items() if n > each}
    if bounds:
        bound = F.create_map(*[F.lit(v) for x in bounds.items() for v in x])[F.col("lang")]
        rows = rows.where(F.pmod("draw", F.lit(1 << 32)) < F.coalesce(bound, F.lit(1 << 32)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        fold = _Fold()
        for b in chunks(batches, "text"):
            langs = b.column("lang").to_pylist()
            of = {lang: np.array([x == lang for x in langs]) for lang in set(langs)}
            for row, bucket in ngram_parts(b.column("text").to_pylist(), np.zeros(len(langs), bool), fold):
                for lang, mine in of.items():
                    part = np.bincount(bucket[mine[row]], minlength=BUCKETS)
                    counts[lang] = counts[lang] + part if lang in counts else part
        for lang, c in counts.items():
            at = np.nonzero(c)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])], ["lang", "bucket", "n"])

    parts = rows.select("lang", "text").mapInArrow(count, "lang string, bucket bigint, n bigint")
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    languages = sorted(docs)
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in sums["lang"]], sums["bucket"]] = sums["n"]
    log_prob = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    prior = np.log(np.array([docs[x] for x in languages]) / total)
    trained = counts.any(1)
    return Model(languages, np.where(trained | ~trained.any(), prior, -np.inf), log_prob)


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Columns of ``df`` but the text, plus lang_pred and score; these take the place of input columns of their names.

    NULL text reads as empty (``und``, 0.0); an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x 2^16 doubles
    rows = packed(df, text=text_of(f"`{text_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = _Fold()
        for b in chunks(batches, "text", 1 << 20):
            lang, score = shared.value.predict(b.column("text").to_pylist(), fold)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(lang, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    others = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c != text_col]
    rows = rows.withColumn("row", F.struct(*(others or [F.lit("").alias("lang_pred")])))  # a struct has a field at least
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return unpacked(rows.mapInArrow(run, schema), lang_pred=F.col("lang_pred"), score=F.col("score"))
