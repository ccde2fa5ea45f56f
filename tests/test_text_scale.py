"""What the text features keep and move: vectors, never n-grams; terms only of documents whose id repeats."""

import re

import pytest

from screensift.operators import text as tt
from screensift.operators import tfidf as tf
from screensift.plans import features as fx
from screensift.plans import q_text as qt


@pytest.fixture
def tables(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    docs = [(i, f"{words[i % 10]}\n" + " ".join(words[(i * k) % (5 + i % 5)] for k in range(1, 9))) for i in range(40)]
    docs += [(3, "alpha beta gamma\nbeta alpha"), (3, "alpha beta"), (None, "alpha beta delta"), (None, "alpha beta"), (50, None), (51, "alpha")]
    labs = [(i, 0, int(i % 3 == 0)) for i in range(30)] + [(5, 0, 1)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labs, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_n_gram_is_kept(spark, tables):
    res = tf.tfidf(qt.corpus(spark, tables))
    assert not re.search(r"InMemoryRelation \[doc_id#\d+L, counts", plan_of(res.vectors)) and "InMemoryRelation" in plan_of(res.vectors)
    assert len(res.held) == 1


def test_labelled_vectors_are_the_cached_ones(spark, tables):
    f = fx.prepare(spark, tables)
    for rows in (f.labelled, f.unlabelled):
        above = plan_of(rows).split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in above and "regexp_extract_all" not in above and "UDF" not in above


def test_a_part_meets_vectors_not_entries(spark, tables):
    plan = plan_of(qt.q_tfidf_by_part(spark, tables)).split("InMemoryRelation")[0]
    assert plan.index("Generate") < plan.index("Join")  # entries are made after the join
    res = tf.tfidf(qt.corpus(spark, tables))
    got = sorted((r.doc_id, r.term_idx, r.value) for r in qt.q_tfidf_by_part(spark, tables).collect() if r.doc_id == 3)
    rows = res.matrix.filter("doc_id = 3").collect()
    assert len(got) == 3 * len(rows)  # three rows of the id, each with each one's entries


def test_ngram_totals_of_repeated_and_missing_ids(spark, tables):
    want = {}
    for r in tf.words(qt.corpus(spark, tables), tf.TfidfOptions()).collect():
        for n in (1, 2, 3):
            want.setdefault((r.doc_id, n), []).extend(" ".join(r.words[i:i + n]) for i in range(len(r.words) - n + 1))
    want = {(d, n, len(g), len(set(g))) for (d, n), g in want.items() if g}
    rows = qt.q_ngrams(spark, tables).collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)


def test_ngrams_of_single_documents_are_not_shuffled(spark, tables):
    asked = []

    def words_of(records):
        asked.append(records.count())
        return tf.words(records, tf.TfidfOptions())

    tt.ngram_sizes(qt.corpus(spark, tables), words_of).collect()
    assert asked == [41, 5]  # rows counted in place; rows of ids that come again (3 and NULL)
