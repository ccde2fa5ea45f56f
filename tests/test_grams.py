"""N-grams counted as numbers: against plain counts, and the Spark ML vectorizer."""

from collections import Counter

import pyarrow as pa

from screensift.functions import grams
from screensift.functions import text as tx
from screensift.operators import models as md
from screensift.operators import tfidf as tf
from screensift.operators import text as tt

TEXTS = ["b a b a b a", "", "a", "a b", "ß é á é", "b a b c d c b a", None, "a a a a"]


def plain(texts, n_min, n_max):
    df, occ = Counter(), Counter()
    for t in texts:
        w = (t or "").split()
        terms = [" ".join(w[i:i + n]) for n in range(n_min, n_max + 1) for i in range(len(w) - n + 1)]
        occ.update(terms)
        df.update(set(terms))
    return {t: (df[t], occ[t]) for t in occ}


def batches(texts):
    return [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], ["words"]) for t in (texts[:3], [], texts[3:])]


def test_counts_of_slices_add_up(monkeypatch):
    for size in (1, 1 << 20):  # a row a slice, and all rows in one
        monkeypatch.setattr(grams, "SLICE_BYTES", size)
        for n_min, n_max in ((1, 3), (2, 2), (3, 5)):
            df, occ = Counter(), Counter()
            for _, words in grams.slices(batches(TEXTS)):
                for terms, d, o in grams.count_grams(words, n_min, n_max):
                    for t, x, y in zip(terms.to_pylist(), d, o):
                        df[t] += int(x)
                        occ[t] += int(y)
            assert {t: (df[t], occ[t]) for t in occ} == plain(TEXTS, n_min, n_max)


def test_index_finds_terms_whose_beginning_is_none():
    index = grams.GramIndex(["a", "a b a", "b c", "d c b a"])
    got = [(r, t, n) for _, words in grams.slices([batches(TEXTS)[0]]) for r, t, n in zip(*(x.tolist() for x in index.counts(words, 1, 4)))]
    assert got == [(0, 0, 3), (0, 1, 2), (2, 0, 1)]
    (_, words), = grams.slices([batches(TEXTS)[2].slice(2, 1)])
    assert [x.tolist() for x in index.counts(words, 1, 4)] == [[0, 0, 0], [0, 2, 3], [2, 1, 1]]
    assert [len(x) for x in grams.GramIndex(["\u0000"]).counts(words, 1, 3)] == [0, 0, 0]


def test_vectors_equal_the_vectorizer(spark):
    rows = [(i, t, f"{t or ''} gamma deltá Éta" if i % 2 else None) for i, t in enumerate(TEXTS)] + [(3, "a b", None), (None, "b a", "c")]
    records = spark.createDataFrame(rows, "doc_id long, title string, abstract string")
    for opts in (tf.TfidfOptions(min_df=1), tf.TfidfOptions(min_df=2, ngram_min=2, max_features=3), tf.TfidfOptions(min_df=99)):
        res = tf.tfidf(records, opts)
        want = md.featurize(records, tf.vectorizer(res.vocabulary, opts), opts)
        order = lambda rows: sorted(rows, key=lambda r: (str(r.doc_id), str(r.features)))
        assert order(res.vectors.collect()) == order(want.collect())
        words = [" ".join(r.words) for r in tf.words(records, opts).collect()]
        assert {r.term: (r.df, r.tf) for r in tf.doc_freq(tf.words(records, opts), opts).collect()} == plain(words, opts.ngram_min, opts.ngram_max)


def test_no_n_gram_is_made_in_the_row(spark):
    records = spark.createDataFrame([(1, "a b c", "d e")], "doc_id long, title string, abstract string")
    opts = tf.TfidfOptions(min_df=1)
    for df in (tf.doc_freq(tf.words(records, opts), opts), tf.tfidf(records, opts).vectors):
        plan = df._jdf.queryExecution().toString()
        assert "MapInArrow" in plan and "sequence(" not in plan and "UDF(" not in plan


def test_document_arrays_equal_the_regrouped_entries(spark):
    rows = [(1, "a b c", None), (2, "b c", "a"), (2, "a d", None), (3, None, None), (None, "a b", "c"), (4, "c c a", "b")]
    records = spark.createDataFrame(rows, "doc_id long, title string, abstract string")
    res = tf.tfidf(records, tf.TfidfOptions(min_df=1))
    docs = res.docs.filter("doc_id IS NULL OR doc_id <> 1")
    key = lambda r: (str(r.doc_id), r.indices)
    assert sorted(tf.document_arrays(res.vectors, docs).collect(), key=key) == sorted(tf.to_vector_arrays(res.matrix, docs).collect(), key=key)


def test_only_text_beyond_ascii_is_translated(spark):
    texts = ["plain", "é́", "", None, "Ångström", "áb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(tx.strip_accents_col(df.t)).collect()] == ["plain", "e", "", None, "Angstrom", "ab"]
    assert tt.word_features(spark.createDataFrame([(1, "Éa b", "c")], "doc_id long, title string, abstract string"), strip_accents=True).first().features == "t_ea t_b a_c"
