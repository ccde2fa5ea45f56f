"""Queries: sources and sinks (S1-S10) as round trips through the shared checkpoint folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from screensift.operators import models as md
from screensift.operators import search as H
from screensift.plans import features as fx
from screensift.plans.registry import register
from screensift.session import scratch_path
from screensift.sources import files as io
from screensift.sources import tables as tb
from screensift.sources.tables import SQL_RECORDS


@register("read_labelled")
def q_read_labelled(spark, sf):
    lab = tb.labelled_records(spark, sf).select(F.col("title").alias("PaperTitle"),
                                                 F.col("abstract").alias("Abstract"), F.col("label").alias("Label"))
    path = scratch_path(spark, "labelled-tsv")
    io.write_tsv(lab, path)
    return io.read_labelled(spark, path, "PaperTitle", "Abstract", "Label")


@register("read_unlabelled", f"""WITH {SQL_RECORDS}
SELECT title, abstract FROM records WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_read_unlabelled(spark, sf):
    unl = tb.unlabelled_records(spark, sf).select("title", "abstract")
    path = scratch_path(spark, "unlabelled-tsv")
    io.write_tsv(unl, path)
    return io.read_unlabelled(spark, path).select("title", "abstract")


@register("search_ranges")
def q_search_ranges(spark, sf):
    from screensift.plans.q_search import merged

    ranges = merged(spark, sf)
    out = None
    for m in ("lightgbm", "xgboost", "SVC", "RandomForestClassifier"):
        path = scratch_path(spark, f"ranges-{m}")
        io.write_text(spark, H.ranges_to_json(ranges, m), path)
        r = H.ranges_from_json(spark, path, m)
        out = r if out is None else out.unionByName(r)
    return out


@register("artifacts_roundtrip")
def q_artifacts_roundtrip(spark, sf):
    from screensift.operators import tfidf as tf
    from screensift.plans.q_search import objective
    from screensift.operators.search import best_trial

    res = tf.tfidf(tb.records(spark, sf))
    out_dir = scratch_path(spark, "artifacts")
    io.write_artifacts(out_dir, res.vocabulary, res.matrix, fx.labels_of(spark, sf),
                       best_trial(objective(spark, sf)), res.vectors)
    back = io.read_artifacts(spark, out_dir)
    parts = [back[k].select(F.lit(k).alias("artifact"), F.count(F.lit(1)).alias("n_rows")) for k in back]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    f = fx.prepare(spark, sf)
    model, _ = md.fit(f.labelled, "xgboost", {"booster": "gblinear", "n_estimators": 20}, n_rows=f.labelled.count())
    pipe = PipelineModel(stages=list(f.vectorizer.stages) + [model])
    path = scratch_path(spark, "model")
    io.save_model(pipe, path)
    loaded = io.load_model(path)
    terms = md.with_terms(tb.unlabelled_records(spark, sf))
    return md.score(loaded, terms.drop("words") if "words" in terms.columns else terms).select("doc_id", "score")
