"""P3 on a stream: records arriving as parquet files are scored and labelled.

The transform is narrow (n-gram arrays -> fitted PipelineModel -> threshold),
so no state store is needed; ``availableNow`` processes everything present
and stops, which makes the same code usable for backfills and schedules.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screensift.operators import models as md
from screensift.operators import tfidf as tf

RECORD_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
])


def classify_stream(spark: SparkSession, source: str, model: PipelineModel, threshold: float, sink: str,
                    checkpoint: str, opts: tf.TfidfOptions = tf.TfidfOptions(), schema: T.StructType = RECORD_SCHEMA,
                    prepare=None):
    """Start an availableNow query from ``source`` (parquet files) to ``sink`` (parquet)."""
    reader = spark.readStream.schema(schema)
    if any(ch in source for ch in "*?["):  # a file-name glob: anchor the base directory
        reader = reader.option("basePath", source.rsplit("/", 1)[0])
    stream = reader.parquet(source)
    if prepare is not None:
        stream = prepare(stream)
    terms = md.with_terms(stream, opts)
    scored = md.score(model, terms).withColumn("pred", (F.col("score") >= F.lit(float(threshold))).cast("int"))
    q = (scored.select("doc_id", "score", "pred").writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).outputMode("append").start())
    return q
