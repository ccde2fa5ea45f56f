"""Shared feature preparation for model queries and jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screensift.operators import labels as lb
from screensift.operators import models as md
from screensift.operators import tfidf as tf
from screensift.sources import tables as tb


@dataclass
class Features:
    tfidf: tf.TfidfResult
    labels: DataFrame          # doc_id, label
    vectorizer: object         # PipelineModel
    labelled: DataFrame        # doc_id, features, label
    unlabelled: DataFrame      # doc_id, features


def labels_of(spark: SparkSession, sf: str, target: str = "toxic") -> DataFrame:
    return lb.binarize(tb.label_table(spark, sf, target), "label", "1").select("doc_id", "label")


def prepare(spark: SparkSession, sf: str, opts: tf.TfidfOptions = tf.TfidfOptions(),
            target: str = "toxic") -> Features:
    """One vocabulary for labelled + unlabelled rows (fitted once, before any split)."""
    recs = tb.records(spark, sf)
    res = tf.tfidf(recs, opts)
    labels = labels_of(spark, sf, target)
    vec = md.vectorizer(res.vocabulary, opts)
    # the vectors of the matrix, cached: featurize() would read and tokenise every text again for each use
    feats = res.vectors
    lab = feats.join(labels, "doc_id")
    unl = feats.join(labels, "doc_id", "left_anti")
    return Features(res, labels, vec, lab, unl)


def centroid_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, label or NULL, score) for every document with the centroid linear model."""
    res = tf.tfidf(tb.records(spark, sf))
    labels = labels_of(spark, sf)
    w = md.centroid_weights(res.matrix, labels, vectors=res.vectors)
    s = md.linear_score(res.matrix, w, res.docs)
    return s.join(labels, "doc_id", "left").select("doc_id", "label", F.round("score", 9).alias("score"))
