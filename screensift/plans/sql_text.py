"""DuckDB SQL for the text and TF-IDF chain, written independently of the Spark code.

Used only as an oracle: each builder returns CTE text to place after WITH.
"""

from __future__ import annotations

from screensift.functions import text as tx
from screensift.sources.tables import SQL_RECORDS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def r6(expr: str) -> str:
    """Round to 6 places and turn -0.0 into 0.0 (same contract as the Spark side)."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


TOKEN_RE = q(tx.TOKEN_PATTERN)
STOP_LIST = "[" + ", ".join(q(w) for w in tx.ENGLISH_STOP_WORDS) + "]"
NON_BLANK_RE = q(tx.NON_BLANK_PATTERN)


def ctes_token_arrays(stop_words: bool = True) -> str:
    def toks(field):
        base = f"regexp_extract_all(lower(coalesce({field}, '')), {TOKEN_RE})"
        if stop_words:
            base = f"list_filter({base}, lambda x: NOT list_contains({STOP_LIST}, x))"
        return base
    return SQL_RECORDS + f""",
tok_arrays AS (
  SELECT doc_id, {toks('title')} AS title_tokens, {toks('abstract')} AS abstract_tokens
  FROM records)"""


def ctes_words(stop_words: bool = True, strip: bool = True) -> str:
    def mark(field, p):
        inner = "strip_accents(x)" if strip else "x"
        return f"list_transform({field}_tokens, lambda x: '{p}' || {inner})"
    return ctes_token_arrays(stop_words) + f""",
word_arrays AS (
  SELECT doc_id, list_concat({mark('title', 't_')}, {mark('abstract', 'a_')}) AS words
  FROM tok_arrays)"""


def ctes_term_counts(stop_words: bool = True, strip: bool = True, n_max: int = 3) -> str:
    ns = ", ".join(f"({n})" for n in range(1, n_max + 1))
    return ctes_words(stop_words, strip) + f""",
grams AS (
  SELECT doc_id, n, array_to_string(words[i:i + n - 1], ' ') AS term
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM word_arrays, (VALUES {ns}) ns(n))),
tc AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
dfreq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM tc GROUP BY term)"""


def ctes_vocabulary(min_df: int = 3, max_features: int = 75000) -> str:
    return ctes_term_counts() + f""",
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx, term,
         CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df,
         ln((CAST(1 AS DOUBLE) + (SELECT count(*) FROM records)) / (CAST(1 AS DOUBLE) + df)) + 1.0 AS idf
  FROM (SELECT * FROM dfreq WHERE df >= {min_df} ORDER BY tf DESC, term LIMIT {max_features}))"""


def ctes_tfidf(min_df: int = 3, max_features: int = 75000) -> str:
    return ctes_vocabulary(min_df, max_features) + """,
raw AS (SELECT tc.doc_id, vocab.term_idx, tc.tf * vocab.idf AS v FROM tc JOIN vocab USING (term)),
tfidf AS (SELECT doc_id, term_idx, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS value FROM raw)"""


def ctes_tokens() -> str:
    rows = []
    for field in ("title", "abstract"):
        rows.append(f"""SELECT doc_id, '{field}' AS field, CAST(i - 1 AS INTEGER) AS pos, arr[i] AS token
  FROM (SELECT doc_id, arr, unnest(generate_series(1, len(arr))) AS i
        FROM (SELECT doc_id, regexp_extract_all(lower(coalesce({field}, '')), {TOKEN_RE}) AS arr FROM records))""")
    return SQL_RECORDS + ",\ntokens AS (\n  " + "\n  UNION ALL\n  ".join(rows) + ")"


def ctes_lemmas() -> str:
    from screensift.operators.text import LEMMA_RULES
    parts = []
    for suffix, repl, min_len, prio in LEMMA_RULES:
        cond = f"suffix(token, {q(suffix)}) AND length(token) >= {min_len}"
        if suffix == "s":
            cond += " AND NOT suffix(token, 'ss')"
        parts.append(f"SELECT token, substr(token, 1, length(token) - {len(suffix)}) || {q(repl)} AS lemma, "
                     f"{prio} AS prio FROM vocab_tok WHERE {cond}")
    return ctes_tokens() + """,
vocab_tok AS (SELECT DISTINCT token FROM tokens),
proposals AS (""" + "\n  UNION ALL ".join(parts) + """),
lemmas AS (
  SELECT token, arg_min(lemma, prio) AS lemma FROM proposals
  WHERE lemma IN (SELECT token FROM vocab_tok) GROUP BY token)"""
