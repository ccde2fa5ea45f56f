"""Term counts, document frequency, vocabulary, TF-IDF.

Plan shape (one corpus):
  documents --tokens in the row--> words --n-grams counted as numbers, an Arrow
  slice of documents at a time--> document frequency: the only shuffle, by term after
  map-side partial aggregation (hot terms collapse before the exchange) -->
  vocabulary: top-k by corpus frequency (TakeOrderedAndProject, bounded by
  max_features), broadcast --> one sparse, L2-normalised vector per document, again
  from its words, cached --> (doc_id, term_idx, value) by one explode.
A document's n-grams are many times its text, so they are made twice (for the
vocabulary and for the vectors) and never kept; only vectors are.
Texts move only where their files are fewer than the cores (see spread). An unbounded vocabulary
(max_features None) meets the counts in a join instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screensift.functions.grams import GramIndex, count_grams, joined, slices
from screensift.functions.prefix import default_buckets, global_rank, quantile_bucket
from screensift.functions import text as tx
from screensift.session import checkpoint
from screensift.operators import text as tt

# Largest vocabulary we sort in one partition and broadcast.
MAX_BROADCAST_VOCABULARY = 2_000_000


@dataclass(frozen=True)
class TfidfOptions:
    min_df: int = 3
    max_features: int | None = 75_000
    ngram_min: int = 1
    ngram_max: int = 3
    stop_words: bool = True
    strip_accents: bool = True
    null_token: str | None = None

    def __post_init__(self):
        if self.min_df < 1:
            raise ValueError("min_df must be >= 1")
        if self.max_features is not None and self.max_features < 1:
            raise ValueError("max_features must be positive or None")
        if not 1 <= self.ngram_min <= self.ngram_max:
            raise ValueError("bad n-gram range")


def spread(records: DataFrame) -> DataFrame:
    """Records dealt by doc_id where their files are fewer than the cores (a small file is one task); else as scanned."""
    if len(records._jdf.inputFiles()) < records.sparkSession.sparkContext.defaultParallelism:
        return records.repartition("doc_id")
    return records


def words(records: DataFrame, opts: TfidfOptions, lemmas: DataFrame | None = None) -> DataFrame:
    return tt.word_arrays(records, stop_words=opts.stop_words, strip_accents=opts.strip_accents,
                          lemmas=lemmas, null_token=opts.null_token)


def term_counts(word_df: DataFrame, opts: TfidfOptions = TfidfOptions()) -> DataFrame:
    """(doc_id, term, tf) raw counts of every n-gram in each document.

    Counted inside each document row (sort + run lengths), so this step is
    narrow: no aggregate and no shuffle.
    """
    return explode_counts(doc_term_arrays(word_df, opts))


def doc_term_arrays(word_df: DataFrame, opts: TfidfOptions = TfidfOptions()) -> DataFrame:
    """(doc_id, counts ARRAY<STRUCT<term, tf>>): one row per document."""
    grams = tx.ngram_col(F.col("words"), opts.ngram_min, opts.ngram_max)
    return word_df.select("doc_id", tx.term_count_col(grams).alias("counts"))


def explode_counts(arrays: DataFrame) -> DataFrame:
    return arrays.select("doc_id", F.inline_outer("counts")).filter(F.col("term").isNotNull())


def doc_freq(word_df: DataFrame, opts: TfidfOptions = TfidfOptions()) -> DataFrame:
    """(term, df, tf) -- documents (rows) containing the term, total occurrences.

    Counted per slice of documents first, so a term of many rows of a slice is one row before the shuffle,
    which comes at once: most n-grams are one slice's alone, and a second count there would merge nothing.
    """
    n_min, n_max = opts.ngram_min, opts.ngram_max

    def run(batches):
        for _, words in slices(batches):
            for terms, df, tf in count_grams(words, n_min, n_max):
                yield pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(tf)], ["term", "df", "tf"])

    counted = word_df.select(joined(F.col("words")).alias("words")).mapInArrow(run, "term string, df long, tf long")
    return counted.repartition("term").groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def idf_col(n_docs: Column, df: Column) -> Column:
    """Smooth idf ln((1+n)/(1+df)) + 1."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def fit_vocabulary(word_df: DataFrame, n_docs: Column, opts: TfidfOptions = TfidfOptions()) -> DataFrame:
    """(term_idx, term, tf, df, idf); term_idx in alphabetical order."""
    kept = doc_freq(word_df, opts).filter(F.col("df") >= opts.min_df)
    if is_bounded(opts):
        top = kept.orderBy(F.desc("tf"), F.asc("term")).limit(opts.max_features)
        # bounded by max_features rows: one partition is safe here and only here
        vocab = top.withColumn("term_idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    else:
        if opts.max_features is not None:
            bucket = quantile_bucket(kept, "tf", default_buckets(kept), descending=True, by=["term"])
            ranked = global_rank(kept, [], F.struct(-F.col("tf"), F.col("term")), bucket)
            kept = ranked.filter(F.col("_idx") <= opts.max_features).drop("_idx", "_n")
        bucket = quantile_bucket(kept, "term", default_buckets(kept))
        vocab = global_rank(kept, [], F.col("term"), bucket).withColumn(
            "term_idx", (F.col("_idx") - 1).cast("int")).drop("_idx", "_n")
    return vocab.select(
        "term_idx", "term", F.col("tf").cast("bigint").alias("tf"), F.col("df").cast("bigint").alias("df"),
        idf_col(n_docs, F.col("df")).alias("idf"),
    )


def fitted_terms(vocab: DataFrame, opts: TfidfOptions) -> tuple[list[str], list[float]]:
    """(terms, idf) in term_idx order; an empty vocabulary is one term that no text has."""
    if not is_bounded(opts):
        raise ValueError("vectorizer needs a bounded vocabulary (max_features)")
    rows = vocab.select("term_idx", "term", "idf").toPandas().sort_values("term_idx")
    return list(rows["term"]) or ["\u0000"], rows["idf"].tolist() or [0.0]


def vectorizer(vocab: DataFrame, opts: TfidfOptions = TfidfOptions()) -> PipelineModel:
    """Fitted TF-IDF as a PipelineModel over the n-gram column ``terms``.

    The vocabulary is bounded by max_features (checked), so bringing it to the
    driver is the same as fitting a CountVectorizer.
    """
    terms, idf = fitted_terms(vocab, opts)
    # from_vocabulary() sends one term a call; terms have no line breaks, so one string takes them all
    array = vocab.sparkSession.sparkContext._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms))
    cv = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    cv.setInputCol("terms").setOutputCol("_tf")
    ep = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    return PipelineModel(stages=[cv, ep, norm])


def is_bounded(opts: TfidfOptions) -> bool:
    return opts.max_features is not None and opts.max_features <= MAX_BROADCAST_VOCABULARY


def document_vectors(word_df: DataFrame, vocab: DataFrame, opts: TfidfOptions = TfidfOptions()) -> DataFrame:
    """(doc_id, features) = L2-normalised tf * idf, from each document's words, as ``vectorizer`` makes them."""
    terms, idf = fitted_terms(vocab, opts)
    fitted = word_df.sparkSession.sparkContext.broadcast((GramIndex(terms), np.array(idf)))
    n_min, n_max = opts.ngram_min, opts.ngram_max

    def run(batches):
        index, weight = fitted.value
        for b, words in slices(batches):
            row, term, tf = index.counts(words, n_min, n_max)
            value = tf * weight[term]
            norm = np.sqrt(np.bincount(row, value * value, b.num_rows))
            start = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(start, pa.array(x)) for x in (term.astype(np.int32), value / norm[row])]
            fixed = [pa.array(np.full(b.num_rows, x)) for x in (np.int8(0), np.int32(index.n_terms))]  # a sparse vector's kind and size
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.StructArray.from_arrays([*fixed, *lists], ["type", "size", "indices", "values"])], ["doc_id", "features"])

    schema = T.StructType([word_df.schema["doc_id"], T.StructField("features", VectorUDT())])
    return word_df.select("doc_id", joined(F.col("words")).alias("words")).mapInArrow(run, schema)


def vector_arrays(vectors: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, keep..., indices, values) of sparse vectors; documents without terms have empty arrays."""
    v = F.unwrap_udt("features")
    return vectors.select("doc_id", *keep, v["indices"].alias("indices"), v["values"].alias("values"))


def vector_entries(vectors: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, keep..., term_idx, value): one row per entry; zero vectors have none."""
    return vector_arrays(vectors, *keep).select("doc_id", *keep, F.inline(F.arrays_zip("indices", "values"))).select(
        "doc_id", *keep, F.col("indices").alias("term_idx"), F.col("values").alias("value"))


def document_arrays(vectors: DataFrame, docs: DataFrame) -> DataFrame:
    """T19 of ``docs``: as ``to_vector_arrays`` of the vectors' entries, but a document's entries move as one row.

    Rows that share an id are one document, with the entries of all of them.
    """
    per_doc = vector_arrays(vectors).groupBy("doc_id").agg(F.collect_list(F.struct("indices", "values")).alias("rows"))
    merged = F.sort_array(F.flatten(F.transform("rows", lambda x: F.arrays_zip(x["indices"], x["values"]))))
    several = F.size("rows") > 1
    return docs.join(per_doc.select("doc_id", F.when(several, F.col("rows")).alias("rows"), F.get("rows", F.lit(0)).alias("row")), "doc_id", "left").select(
        "doc_id",
        *[F.coalesce(F.when(several, merged[c]), F.col("row")[c], F.array().cast(kind)).alias(c)
          for c, kind in (("indices", "array<int>"), ("values", "array<double>"))])


def transform(tc: DataFrame, vocab: DataFrame) -> DataFrame:
    """T16/T17 for a vocabulary without a bound: (doc_id, term_idx, value) by a join on the term."""
    raw = tc.join(vocab.select("term", "term_idx", "idf"), "term").select("doc_id", "term_idx", (F.col("tf") * F.col("idf")).alias("v"))
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term_idx", (F.col("v") / norm).alias("value"))


@dataclass
class TfidfResult:
    vocabulary: DataFrame      # term_idx, term, tf, df, idf
    matrix: DataFrame          # doc_id, term_idx, value
    n_features: Column         # scalar subquery: vocabulary size
    docs: DataFrame            # doc_id of every corpus row (empty documents included)
    held: tuple[DataFrame, ...] = ()   # persisted; release with unpersist()
    vectors: DataFrame | None = None   # doc_id, features (bounded vocabularies)

    def unpersist(self) -> None:
        for df in self.held:
            df.unpersist()


def tfidf(records: DataFrame, opts: TfidfOptions = TfidfOptions(), lemmas: DataFrame | None = None) -> TfidfResult:
    """Whole chain with one vocabulary for the corpus given (labelled + unlabelled)."""
    word_df = words(spread(records), opts, lemmas)
    held = ()
    if lemmas is not None:  # lemmas meet the tokens in a join: done once for the vocabulary and the vectors
        word_df = word_df.persist(StorageLevel.MEMORY_AND_DISK)
        held = (word_df,)
    n_docs = records.select(F.count(F.lit(1))).scalar()
    # the fitted state is small (<= max_features rows): cut its lineage once in the
    # shared checkpoint folder so every consumer reads it instead of re-fitting
    vocab = checkpoint(fit_vocabulary(word_df, n_docs, opts))
    n_features = vocab.select(F.count(F.lit(1))).scalar()
    if not is_bounded(opts):
        matrix = transform(term_counts(word_df, opts), vocab).persist(StorageLevel.MEMORY_AND_DISK)
        return TfidfResult(vocab, matrix, n_features, records.select("doc_id"), (*held, matrix))
    vectors = document_vectors(word_df, vocab, opts).persist(StorageLevel.MEMORY_AND_DISK)
    return TfidfResult(vocab, vector_entries(vectors), n_features, records.select("doc_id"), (*held, vectors), vectors)


def with_part(labelled: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """One corpus from two tables, remembering where each row came from."""
    cols = ["doc_id", "title", "abstract"]
    return labelled.select(*cols, F.lit("labelled").alias("part")).unionByName(
        unlabelled.select(*cols, F.lit("unlabelled").alias("part")))


def to_vector_arrays(matrix: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, indices, values) sorted by term_idx; documents without terms get []."""
    per_doc = matrix.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("term_idx", "value"))).alias("e"))
    return docs.join(per_doc, "doc_id", "left").select(
        "doc_id",
        F.coalesce(F.col("e.term_idx"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("e.value"), F.array().cast("array<double>")).alias("values"),
    )
