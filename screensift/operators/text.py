"""Tokens, stop words, lemmas, field markers, n-grams.

Token arrays stay inside the row (no shuffle); the long token table is only
built for the operators that need a row per token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screensift.functions import text as tx

FIELDS = ("title", "abstract")


def field_text(col: str, null_token: str | None = None):
    """NULL field -> empty text (default) or ``null_token`` (the reference writes 'nan')."""
    c = F.col(col)
    return F.coalesce(c, F.lit(null_token)) if null_token is not None else c


def tokens(records: DataFrame, null_token: str | None = None) -> DataFrame:
    """Long token table (doc_id, field, pos, token), lower-cased, 0-based pos."""
    out = None
    for field in FIELDS:
        part = records.select(
            "doc_id",
            F.lit(field).alias("field"),
            F.posexplode(tx.tokenize_col(field_text(field, null_token))).alias("pos", "token"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def content_tokens(tokens_long: DataFrame) -> DataFrame:
    """Drop stop words (bounded literal set, tested on the surface token)."""
    return tokens_long.filter(~F.col("token").isin(*tx.ENGLISH_STOP_WORDS))


# Suffix rules that propose a lemma; a proposal is kept only when the proposed
# form is itself a token of the corpus (fixed values: suffix, replacement,
# minimum token length, priority).
LEMMA_RULES = (
    ("ies", "y", 5, 1),
    ("sses", "ss", 5, 2),
    ("xes", "x", 4, 3),
    ("ches", "ch", 5, 4),
    ("shes", "sh", 5, 5),
    ("s", "", 4, 6),
)


def lemma_table(tokens_long: DataFrame) -> DataFrame:
    """T2 seed: (token, lemma) pairs proposed by suffix rules and confirmed by the corpus."""
    vocab = tokens_long.select("token").distinct()
    proposals = None
    for suffix, repl, min_len, prio in LEMMA_RULES:
        cond = F.col("token").endswith(suffix) & (F.length("token") >= min_len)
        if suffix == "s":
            cond = cond & ~F.col("token").endswith("ss")
        cand = vocab.filter(cond).select(
            "token",
            F.concat(F.expr(f"substring(token, 1, length(token) - {len(suffix)})"), F.lit(repl)).alias("lemma"),
            F.lit(prio).alias("prio"),
        )
        proposals = cand if proposals is None else proposals.unionByName(cand)
    confirmed = proposals.join(vocab.withColumnRenamed("token", "lemma"), "lemma", "left_semi")
    return confirmed.groupBy("token").agg(F.min_by("lemma", "prio").alias("lemma"))


def lemmatize(tokens_long: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each token by its lemma where the table has one.

    No broadcast hint: the lemma table grows with the corpus vocabulary, so the
    choice is left to AQE's runtime size check.
    """
    return tokens_long.join(lemmas, "token", "left").withColumn(
        "lemma", F.coalesce(F.col("lemma"), F.col("token"))
    )


def token_arrays(records: DataFrame, stop_words: bool = True, null_token: str | None = None) -> DataFrame:
    """Per document: title and abstract token arrays (T1, T3, T4), no shuffle."""
    cols = []
    for field in FIELDS:
        toks = tx.tokenize_col(field_text(field, null_token))
        if stop_words:
            toks = tx.drop_stop_words_col(toks)
        cols.append(toks.alias(f"{field}_tokens"))
    return records.select("doc_id", *cols)


def _prefixed(arrays: DataFrame, strip_accents: bool) -> DataFrame:
    def mark(field):
        prefix = tx.FIELD_PREFIX[field]
        if strip_accents:
            return F.transform(f"{field}_tokens", lambda t: F.concat(F.lit(prefix), tx.strip_accents_col(t)))
        return F.transform(f"{field}_tokens", lambda t: F.concat(F.lit(prefix), t))

    return arrays.select("doc_id", F.concat(mark("title"), mark("abstract")).alias("words"))


def _field_is(i: int):
    return lambda x: x["f"] == i


def word_arrays(records: DataFrame, stop_words: bool = True, strip_accents: bool = False,
                lemmas: DataFrame | None = None, null_token: str | None = None) -> DataFrame:
    """T5/T6 (+T7): (doc_id, words ARRAY) -- title words then abstract words, marked t_/a_."""
    if lemmas is None:
        return _prefixed(token_arrays(records, stop_words, null_token), strip_accents)
    toks = tokens(records, null_token)
    if stop_words:
        toks = content_tokens(toks)
    toks = lemmatize(toks, lemmas)
    arr = toks.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct(
            (F.col("field") != "title").cast("int").alias("f"), "pos", "lemma"))).alias("s")
    )
    arr = records.select("doc_id").join(arr, "doc_id", "left").select(
        "doc_id",
        *[F.coalesce(F.transform(F.filter("s", _field_is(i)), lambda x: x["lemma"]),
                     F.array().cast("array<string>")).alias(f"{f}_tokens")
          for i, f in enumerate(FIELDS)],
    )
    return _prefixed(arr, strip_accents)


def word_features(records: DataFrame, **kw) -> DataFrame:
    """T6 string form: (doc_id, features) space-joined marked words."""
    return word_arrays(records, **kw).select("doc_id", F.array_join("words", " ").alias("features"))


def ngrams(words: DataFrame, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """One row per n-gram occurrence (doc_id, term)."""
    return words.select("doc_id", F.explode(tx.ngram_col(F.col("words"), n_min, n_max)).alias("term"))


def ngram_sizes(records: DataFrame, words_of, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """T9 totals: (doc_id, n, n_grams, n_distinct) per document; ``words_of`` makes (doc_id, words) of records.

    A document of one row is counted inside the row. Rows that share an id are one
    document, whose distinct n-grams are counted by a shuffle of theirs alone.
    """
    sizes = range(n_min, n_max + 1)
    shared = records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1).select(F.col("doc_id").alias("_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    alone, together = (words_of(records.join(shared, same, how)) for how in ("left_anti", "left_semi"))
    counted = F.flatten(F.transform(F.array("words"), lambda w: F.array(*[F.struct(
        F.lit(n).alias("n"), (F.size(w) - (n - 1)).cast("long").alias("n_grams"),
        F.size(F.array_distinct(tx.ngram_col(w, n, n))).cast("long").alias("n_distinct")) for n in sizes])))
    grams = F.concat(*[F.transform(tx.ngram_col(F.col("words"), n, n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("term"))) for n in sizes])
    return alone.select("doc_id", F.inline(counted)).filter(F.col("n_grams") > 0).unionByName(
        together.select("doc_id", F.inline(grams)).groupBy("doc_id", "n").agg(
            F.count(F.lit(1)).alias("n_grams"), F.countDistinct("term").alias("n_distinct")))
