"""Readers and writers.

Writes never overwrite (mode 'errorifexists'), as the reference's uploads.
All paths are expected on shared storage (the job options name them).
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screensift.operators.tfidf import vector_entries
from screensift.sources.quoted import quoted_records

# fixed values: text that pandas reads as missing by default
NA_STRINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

TSV_OPTIONS = {"sep": "\t", "header": "true", "multiLine": "true", "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _na_to_null(col: str):
    c = F.col(f"`{col}`")
    return F.when(c.isin(*NA_STRINGS), F.lit(None)).otherwise(c)


def read_tsv(spark: SparkSession, path: str, columns: dict[str, str], part: int = 0) -> DataFrame:
    """Read a TSV with header, keep and rename ``columns`` {header: name}; every field is text.

    Fields may hold tabs and line breaks in quotes; a file is read by as many
    tasks as it has splits (``quoted``). The header is the first record of every
    file, without line breaks, the same in all. Rows get a doc_id from their
    position in the input splits (stable for a given input), counted from 2^52
    times ``part``, so that inputs read as different parts share no ids.
    """
    names = spark.read.options(**{**TSV_OPTIONS, "multiLine": "false"}).csv(path).columns
    missing = [h for h in columns if h not in names]
    if missing:
        raise ValueError(f"missing columns {missing} in {path}")
    records = quoted_records(spark, path)
    first = records.groupBy("file").agg(F.min("position").alias("header"))  # a row a file
    schema = ", ".join(f"_{i} STRING" for i in range(len(names)))
    options = {k: v for k, v in TSV_OPTIONS.items() if k not in ("header", "multiLine")}
    rows = records.join(F.broadcast(first), "file").where("position > header").select(
        "position", F.from_csv("value", schema, {**options, "mode": "PERMISSIVE"}).alias("r"))
    out = rows.select(F.col("position"), *[F.col("r")[f"_{names.index(h)}"].alias(n) for h, n in columns.items()])
    return out.select((F.col("position") + F.lit(part << 52)).alias("doc_id"), *[_na_to_null(n).alias(n) for n in columns.values()])


def read_labelled(spark: SparkSession, path: str, title_header: str = "title",
                  abstract_header: str = "abstract", label_header: str = "included") -> DataFrame:
    """(doc_id, title, abstract, label STRING)."""
    return read_tsv(spark, path, {title_header: "title", abstract_header: "abstract", label_header: "label"})


def read_unlabelled(spark: SparkSession, path: str, title_header: str = "title",
                    abstract_header: str = "abstract") -> DataFrame:
    """(doc_id, title, abstract); parquet directories are read as they are."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
        return df.select("doc_id", F.col(title_header).alias("title"), F.col(abstract_header).alias("abstract"))
    return read_tsv(spark, path, {title_header: "title", abstract_header: "abstract"}, part=1)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").options(**TSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, cluster_by: str | None = None) -> None:
    """Parquet, never overwriting; optionally clustered by a key within files."""
    out = df.sortWithinPartitions(cluster_by) if cluster_by else df
    out.write.mode("errorifexists").parquet(path)


def write_artifacts(out_dir: str, vocabulary: DataFrame, matrix: DataFrame, labels: DataFrame,
                    best: DataFrame | None = None, vectors: DataFrame | None = None) -> dict[str, str]:
    """TF-IDF (long form, clustered by doc_id), vocabulary, labels, best parameters.

    Where the matrix comes from ``vectors``, those are sorted, a row a document, and its entries follow in order.
    """
    paths = {k: os.path.join(out_dir, k) for k in ("tfidf", "vocabulary", "labels", "best_params")}
    if vectors is None:
        write_parquet(matrix, paths["tfidf"], "doc_id")
    else:
        write_parquet(vector_entries(vectors.sortWithinPartitions("doc_id")), paths["tfidf"])
    write_parquet(vocabulary, paths["vocabulary"], "term_idx")
    write_parquet(labels, paths["labels"], "doc_id")
    if best is not None:
        best.write.mode("errorifexists").json(paths["best_params"])
    return paths


def read_artifacts(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Load what write_artifacts wrote (each directory holds one dataset)."""
    out = {}
    for k in ("tfidf", "vocabulary", "labels"):
        out[k] = spark.read.parquet(os.path.join(out_dir, k))
    try:
        out["best_params"] = spark.read.json(os.path.join(out_dir, "best_params"))
    except AnalysisException:
        pass
    return out


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document (e.g. search ranges JSON) written through Spark to shared storage."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence; refuses to overwrite."""
    model.write().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
