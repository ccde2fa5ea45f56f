"""Toxicity by a classifier chain (operator 4).

Categories are predicted one after the other; each category's linear model sees the words and
word stems of the text and the probabilities of the categories before it. While training,
those come from out-of-fold models, so a later model never learns from
probabilities fitted on its own rows.

The chain is fitted on a bounded sample of labelled rows (``max_train``); a category's model uses
all words and stems that are significant by chi-square against it, as far as the false discoveries
among them stay rare (Benjamini-Hochberg), so no language needs an absolute number of rows. The
models of a category are fitted together, each pass over the sample a distributed
job (``operators.batched``). Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from screensift.llm.frames import chunks, materialise, packed, text_of, unpacked
from screensift.operators.batched import NONE, TRAIN, VALID, fit_logistic_many, margins, row_slices, sparse_arrays

#: Labelled rows that train the chain (about; all, if there are fewer).
MAX_TRAIN = 20_000
#: A word on a single sample document is not tested; share of false discoveries among the words chosen.
MIN_DOCS, FALSE_SHARE = 2, 0.05
FOLDS, RIDGE, THRESHOLD = 5, 0.3, 0.5
#: Rounds of the optimiser, and the relative gain of the loss at which it ends.
ROUNDS, TOLERANCE = 40, 1e-4
STEMS = (3, 4, 5, 6)

#: ASCII letters in lower case and all non-ASCII bytes make words.
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()


def default_chain() -> dict[str, Column]:
    """Categories in chain order, as conditions on a label row."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1,
            "toxic_low_quality": (F.col("toxic") == 1) & (F.col("quality") == 0)}


def word_set(text: str) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").translate(_FOLD).split())


def features_of(word: bytes) -> list[bytes]:
    """The word itself and its stems (first 3 to 6 bytes), so inflected forms share what was learnt."""
    return [word, *(b"^" + word[:n] for n in STEMS if n <= len(word))]


def feature_set(text: str) -> set[bytes]:
    return {f for w in word_set(text) for f in features_of(w)}


class _Known(dict):
    """word -> numbers of its known features, filled as words turn up and emptied when it has a million."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = tuple(self.vocabulary[f] for f in features_of(word) if f in self.vocabulary)
        return value

    def of(self, text: str) -> list[int]:
        return sorted({i for w in word_set(text) if (known := self[w]) for i in known})


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Chain:
    """Categories, words and one parameter vector (words, earlier categories, bias) per category."""

    categories: list[str]
    words: dict[bytes, int]
    parameters: list[np.ndarray]

    def probabilities(self, row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        """(n, categories) for ``n`` texts with words at (row, col)."""
        out = np.zeros((n, len(self.categories)))
        v = len(self.words)
        for j, t in enumerate(self.parameters):
            z = np.bincount(row, weights=t[col], minlength=n) + _logit(out[:, :j]) @ t[v:-1] + t[-1]
            out[:, j] = _sigmoid(z)
        return out


def significant_at(tested: DataFrame, share: float = FALSE_SHARE) -> float:
    """The chi-square from which words are taken so that about ``share`` of them are false discoveries: Benjamini-Hochberg over all tested words.

    The step-up rule takes the words whose p is at most share * taken / tested;
    counting again, from all words down, reaches its largest solution. Each
    count is one aggregation.
    """
    total = taken = tested.count()
    while taken:
        cut = chi2_of(share * taken / total)
        now = tested.where(F.col("chi2") >= cut).count()
        if now == taken:
            return cut
        taken = now
    return math.inf


def chi2_of(p: float) -> float:
    """The chi-square of one degree of freedom that is exceeded with probability ``p``, by bisection."""
    low, high = 0.0, 2000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if math.erfc(math.sqrt(mid / 2)) > p else (low, mid)
    return high


def _constant(model: int, counts: list) -> float | None:
    """Margin of a model whose training rows are of one class only, from (fold, known, positive) counts; None where it has both."""
    known = sum(c.known for c in counts if c.fold != model)
    positive = sum(c.positive for c in counts if c.fold != model)
    if 0 < positive < known:
        return None
    return float(_logit(np.array((positive + 0.5) / (known + 1.0)))) if known else -30.0


def fit_chain(rows: DataFrame, words: dict[bytes, int], categories: list[str], ridge: float = RIDGE) -> Chain:
    """Rows (at: for each category the numbers of its significant words, y: a label a category or NULL, fold) -> the chain.

    For each category one model a fold, without that fold's rows, and one of
    all rows are fitted together (``batched``); the fold's models then give every
    row its out-of-fold margin as one more column for the later categories.
    """
    rows = rows.withColumn("earlier", F.array().cast("array<double>"))
    parameters = []
    for j in range(len(categories)):
        label, at = F.col("y")[j], F.col("at")[j]
        indices = F.concat(at, F.array(*[F.lit(len(words) + i) for i in range(j)]).cast("array<int>"))
        values = F.concat(F.transform(at, lambda _: F.lit(1.0)), F.col("earlier"))
        role = [F.when(F.col("fold") == k, VALID).when(label.isNotNull(), TRAIN).otherwise(NONE) for k in range(FOLDS)]
        role.append(F.when(label.isNotNull(), TRAIN).otherwise(NONE))
        now = rows.select("*", indices.alias("indices"), values.alias("values"), F.coalesce(label, F.lit(0.0)).alias("label"), F.array(*role).cast("array<tinyint>").alias("role")).persist(
            StorageLevel.MEMORY_AND_DISK)
        theta = fit_logistic_many(now, len(words) + j, FOLDS + 1, l2=ridge, average=False, max_iter=ROUNDS, tol=TOLERANCE)
        counts = now.groupBy("fold").agg(F.count(label).alias("known"), F.coalesce(F.sum(label), F.lit(0.0)).alias("positive")).collect()
        for k in range(FOLDS + 1):
            constant = _constant(k, counts)
            if constant is not None:
                theta[:, k] = 0
                theta[-1, k] = constant
        parameters.append(theta[:, FOLDS])
        if j + 1 < len(categories):
            rows = materialise(_with_margin(now, theta[:, :FOLDS]), "toxicity-rows")
        now.unpersist()
    return Chain(categories, words, parameters)


def _with_margin(rows: DataFrame, theta: np.ndarray) -> DataFrame:
    """Rows with their out-of-fold log-odds as one more value in ``earlier``."""
    shared = rows.sparkSession.sparkContext.broadcast(theta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in row_slices(big, 1 << 20):
                fold = b.column(2).to_numpy(zero_copy_only=False)
                z = _logit(_sigmoid(margins(*sparse_arrays(b), shared.value)[np.arange(b.num_rows), fold]))
                earlier = [[*e, x] for e, x in zip(b.column(3).to_pylist(), z)]
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(earlier, pa.list_(pa.float64()))], ["at", "y", "fold", "earlier"])

    return rows.select("at", "y", "fold", "earlier", "indices", "values").mapInArrow(
        run, "at array<array<int>>, y array<double>, fold bigint, earlier array<double>")


def train(docs: DataFrame, labels: DataFrame, chain: dict[str, Column] | None = None, id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN) -> Chain:
    """Fit the chain on labelled documents.

    A label row counts for a category where its condition is not NULL; a document labelled
    twice is positive if one of the rows says so. NULL ids, labels without a
    document and documents without a label do not train; without labels all
    probabilities are (almost) zero.
    """
    chain = default_chain() if chain is None else chain
    names = list(chain)
    per = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        *[F.max(c.cast("double")).alias(f"y{j}") for j, c in enumerate(chain.values())])
    draw = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 32))
    total = per.count()
    if total > max_train:
        per = per.where(draw < F.lit(int((1 << 32) * max_train / total)))
    # the sample's ids and labels are bounded by max_train, so they go to the documents
    sample = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text")).join(
        F.broadcast(per), "id").select("text", F.array(*[F.col(f"y{j}") for j in range(len(names))]).alias("y"),
                                       F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).alias("fold"))
    sample = materialise(sample, "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, Counter] = {}
        for b in chunks(batches, "text"):
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                totals.setdefault(tuple(y), Counter()).update(feature_set(text))
        for y, words in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.binary()), pa.array([list(y)] * len(words), pa.list_(pa.float64())), pa.array(list(words.values()), pa.int64())],
                ["word", "y", "n"])

    per_word = sample.select("text", "y").mapInArrow(count, "word binary, y array<double>, n bigint")
    sums = [(F.sum("n"), "n")] + [x for j in range(len(names)) for x in (
        (F.sum(F.when(F.col("y")[j] == 1, F.col("n")).otherwise(0)), f"pos{j}"), (F.sum(F.when(F.col("y")[j].isNotNull(), F.col("n")).otherwise(0)), f"known{j}"))]
    counts = per_word.groupBy("word").agg(*[c.alias(a) for c, a in sums]).where(F.col("n") >= MIN_DOCS)
    base = sample.agg(*[c.alias(a) for j in range(len(names)) for c, a in (
        (F.coalesce(F.sum(F.col("y")[j]), F.lit(0.0)), f"pos{j}"), (F.count(F.col("y")[j]), f"known{j}"))]).first()
    scores = []
    for j in range(len(names)):
        rate, score = base[f"pos{j}"] / max(1, base[f"known{j}"]), F.lit(0.0)
        if 0 < rate < 1:
            d = F.col(f"pos{j}") - F.col(f"known{j}") * rate
            score = d * d / (F.greatest(F.col(f"known{j}"), F.lit(1)) * (rate * (1 - rate)))
        scores.append(score.alias(f"chi2_{j}"))
    tested = materialise(counts.select("word", *scores), "toxicity-words")
    cuts = [significant_at(tested.select(F.col(f"chi2_{j}").alias("chi2"))) for j in range(len(names))]
    taken = [F.col(f"chi2_{j}") >= F.lit(cut) for j, cut in enumerate(cuts)]
    # the model's own words: as many as are significant on the bounded sample
    best = tested.where(reduce(or_, taken, F.lit(False))).select("word", F.array(*taken).alias("taken")).orderBy("word").collect()
    words = {bytes(r.word): i for i, r in enumerate(best)}
    of = np.array([r.taken for r in best], bool).reshape(len(best), len(names)).T

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(words)
        for b in chunks(batches, "text"):
            at = [np.array(known.of(t), np.int32) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[a[mine[a]] for mine in of] for a in at], pa.list_(pa.list_(pa.int32()))), b.column("y"), b.column("fold")], ["at", "y", "fold"])

    return fit_chain(materialise(sample.mapInArrow(rows, "at array<array<int>>, y array<double>, fold bigint"), "toxicity-rows"), words, names)


def scored(df: DataFrame, model: Chain) -> DataFrame:
    """(row, text) -> row, p: the chain's probabilities in category order."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # the words that are significant on max_train rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        known = _Known(chain.words)
        for b in chunks(batches, "text"):
            at = [known.of(t) for t in b.column("text").to_pylist()]
            col = np.array([c for a in at for c in a], np.int64)
            row = np.repeat(np.arange(len(at)), [len(a) for a in at])
            p = chain.probabilities(row, col, len(at))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(list(p), pa.list_(pa.float64()))], ["row", "p"])

    schema = StructType([df.schema["row"], StructField("p", ArrayType(DoubleType()))])
    return df.select("row", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             chain: dict[str, Column] | None = None, threshold: float = THRESHOLD, reject: str = "toxic") -> DataFrame:
    """Input columns plus p_<category> for every category and ``rejected`` (probability of ``reject`` at ``threshold`` or more).

    One row per input row, repeated rows included; NULL text reads as empty (the
    chain's base rates); an empty table gives an empty result.
    """
    model = train(docs, labels, chain, id_col, text_col)
    out = scored(packed(docs, text=text_of(f"`{text_col}`")), model)
    p = {c: F.col("p")[j] for j, c in enumerate(model.categories)}
    return unpacked(out, **{f"p_{c}": v for c, v in p.items()}, rejected=p[reject] >= threshold)


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, reject: str = "toxic") -> DataFrame:
    """Filter: documents that the chain rejects go, the others stay unchanged.

    Repeated rows share their fate; a NULL text is judged as the empty one, and
    an empty table gives an empty result.
    """
    model = train(docs, labels, None, id_col, text_col)
    out = scored(packed(docs, text=text_of(f"`{text_col}`")), model)
    return out.where(F.col("p")[model.categories.index(reject)] < threshold).select("row.*")
