"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Stages filter or rewrite whole documents and keep their columns; only the last
adds the mix's own (mix_epoch, mix_time). Run with ``run(spark, sf_dir)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screensift.llm import decontam, line_dedup, mixing, simhash, toxicity
from screensift.llm.frames import materialise
from screensift.sources.tables import table

#: SQL can express neither the classifier chain nor XXH64 fingerprints; tests hold the rows against a plain version.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier chain rejects go."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: lines on too large a share of their source's documents go, documents stay."""
    return line_dedup.drop_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: contaminated documents go, shorter benchmark passages are cut out."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the copies of documents that mix the sources to their targets."""
    return mixing.mixture(docs)


STAGES = [("toxicity", reject_toxic), ("line_dedup", drop_lines), ("simhash_dedup", drop_near_duplicates),
          ("decontamination", remove_benchmark), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows lie in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
