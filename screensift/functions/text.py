"""Text constants and column expressions used by the featurisation chain."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Token rule: a run of letters/digits (combining marks allowed after the first
# character), optionally joined by single apostrophes or hyphens. Punctuation
# and whitespace never match, so they never become tokens.
TOKEN_PATTERN = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*(?:['\-][\p{L}\p{M}\p{N}]+)*"

# Field markers put in front of every word, title first (fixed values).
FIELD_PREFIX = {"title": "t_", "abstract": "a_"}

# Whitespace as Python's str.isspace() sees it, derived by rule. A field is
# blank when it contains no character outside this set.
WHITESPACE_CHARS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())

# Apache Spark's default English stop words (StopWordsRemover, fixed values).
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's
she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split())


def _regex_class(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):04X}}}" for c in chars)


# A field holds content when some character is not whitespace.
NON_BLANK_PATTERN = f"[^{_regex_class(WHITESPACE_CHARS)}]"


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str, str]:
    """(from, to, deleted) characters for accent stripping, derived by rule.

    Rule: a BMP character whose canonical decomposition is one base character
    followed only by combining marks maps to that base; stand-alone combining
    marks are deleted. This is what NFD + "drop marks" does for precomposed
    letters, expressed as a single ``translate`` so it runs inside codegen.
    """
    src, dst, deleted = [], [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF:
            continue
        if unicodedata.category(ch) == "Mn":
            deleted.append(ch)
            continue
        nfd = unicodedata.normalize("NFD", ch)
        if len(nfd) > 1 and nfd[0] != ch and all(unicodedata.category(c) == "Mn" for c in nfd[1:]):
            base = nfd[0]
            if unicodedata.category(base) != "Mn":
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst), "".join(deleted)


def strip_accents_col(col: Column) -> Column:
    """Remove accents with one JVM ``translate`` (Latin and other precomposed letters); pure ASCII has none."""
    src, dst, deleted = accent_map()
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(F.translate(col, src + deleted, dst))


def is_blank(col: Column) -> Column:
    """NULL, empty or whitespace-only (Unicode whitespace, not just ASCII)."""
    return ~F.coalesce(col, F.lit("")).rlike(NON_BLANK_PATTERN)


def tokenize_col(col: Column) -> Column:
    """Lower-case and extract word tokens as ARRAY<STRING>; NULL text gives []."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), 0),
        F.array().cast("array<string>"),
    )


def stop_word_array() -> Column:
    return F.array(*[F.lit(w) for w in ENGLISH_STOP_WORDS])


def drop_stop_words_col(tokens: Column) -> Column:
    """Filter stop words out of a token array (bounded literal set, no join).

    ``isin`` over many literals is rewritten by the optimizer to a hash-set
    lookup (InSet), unlike ``array_contains``, which scans the list per token.
    """
    return F.filter(tokens, lambda t: ~t.isin(*ENGLISH_STOP_WORDS))


def _gram_of(words: Column, n: int):
    # one-argument lambda: PySpark passes the element index to two-argument ones
    if n == 1:
        return lambda i: F.element_at(words, i)
    return lambda i: F.concat_ws(" ", *[F.element_at(words, i + k) for k in range(n)])


def _ngrams_of(words: Column, n_min: int, n_max: int) -> Column:
    parts = []
    for n in range(n_min, n_max + 1):
        size = F.size(words)
        grams = F.transform(F.sequence(F.lit(1), size - n + 1), _gram_of(words, n))
        parts.append(F.when(size >= n, grams).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def ngram_col(words: Column, n_min: int = 1, n_max: int = 3) -> Column:
    """All word n-grams (n_min..n_max) of an array, space-joined, in order.

    ``words`` is bound once as a lambda variable: referencing an inlined
    expression inside the per-element lambdas would re-evaluate the whole
    tokenisation for every n-gram.
    """
    return F.flatten(F.transform(F.array(words), lambda w: _ngrams_of(w, n_min, n_max)))


def _runs_of(s: Column) -> Column:
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                      lambda i: (i <= n) & ((i == 1) | (F.element_at(s, i) != F.try_element_at(s, i - 1))))
    # bind ``starts`` once (see ngram_col) before indexing into it per element
    return F.flatten(F.transform(F.array(starts), lambda st: F.transform(
        st, lambda x, j: F.struct(F.element_at(s, x).alias("term"),
                                  (F.coalesce(F.try_element_at(st, j + 2), n + 1) - x).cast("long").alias("tf")))))


def term_count_col(terms: Column) -> Column:
    """ARRAY<STRUCT<term, tf>>: distinct terms of one document with their counts.

    Sorts the document's own terms and counts runs, inside the row: no
    aggregation operator and no shuffle is needed for per-document counts.
    """
    return F.flatten(F.transform(F.array(F.sort_array(terms)), lambda s: _runs_of(s)))
