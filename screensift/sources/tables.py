"""Stand-ins for the reference's inputs, derived from the given parquet tables.

records    : documents -> title = first line of text, abstract = the rest
labels     : labels.toxic = 1 is the (rare) positive class; quality is the second target
unlabelled : documents without a labels row (anti join)
scores     : lineitem -> label l_returnflag = 'R', score round(l_quantity * (1 - l_discount), 2),
             model = l_linestatus, fold = l_linenumber
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, abstract): abstract is NULL when the text has a single line."""
    text = F.col("text")
    nl = F.instr(text, "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\\n') - 1)")).otherwise(text).alias("title"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).alias("abstract"),
    )


def label_table(spark: SparkSession, sf_dir: str, target: str = "toxic") -> DataFrame:
    """Raw label column as text (the reference reads labels from TSV)."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col(target).cast("string").alias("label"))


def labelled_records(spark: SparkSession, sf_dir: str, target: str = "toxic") -> DataFrame:
    """(doc_id, title, abstract, label STRING)."""
    return records(spark, sf_dir).join(label_table(spark, sf_dir, target), "doc_id")


def unlabelled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 stand-in: documents with no labels row."""
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return records(spark, sf_dir).join(lab, "doc_id", "left_anti")


def proxy_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large score table with many ties: (model, fold, okey, lnum, label, score)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linestatus").alias("model"),
        F.col("l_linenumber").cast("int").alias("fold"),
        F.col("l_orderkey").alias("okey"),
        F.col("l_partkey").alias("pkey"),
        F.col("l_suppkey").alias("skey"),
        F.col("l_linenumber").cast("int").alias("lnum"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.round(F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount")), 2).alias("score"),
    )


# SQL text of the same stand-ins, for the DuckDB oracle (tables are views there).
SQL_RECORDS = """records AS (
  SELECT doc_id,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract
  FROM documents)"""

SQL_PROXY_SCORES = """scores AS (
  SELECT l_linestatus AS model, CAST(l_linenumber AS INTEGER) AS fold, l_orderkey AS okey,
         l_partkey AS pkey, l_suppkey AS skey, CAST(l_linenumber AS INTEGER) AS lnum,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         round(l_quantity * (1.0 - l_discount), 2) AS score
  FROM lineitem)"""
