"""DuckDB SQL oracles for the closed-form linear model, CV and learning curves."""

from __future__ import annotations

from screensift.plans.sql_text import ctes_tfidf

LAB = "lab AS (SELECT doc_id, CAST(toxic = 1 AS INTEGER) AS label FROM labels)"


def sql_auc(name: str, src: str, groups: list[str]) -> str:
    """CTE ``name`` (groups..., auc) from ``src`` (groups..., label, score)."""
    g = ", ".join(groups)
    gs = g + ", " if g else ""
    pg = f"PARTITION BY {g}" if g else ""
    gb = f"GROUP BY {g}" if g else ""
    return f"""{name}_sc AS (SELECT {gs}score, sum(label) AS pos, sum(1 - label) AS neg FROM {src}
  GROUP BY {gs}score),
{name}_cc AS (SELECT {gs}pos, neg, sum(neg) OVER ({pg} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
  sum(pos) OVER ({pg}) AS tp_all, sum(neg) OVER ({pg}) AS tn_all FROM {name}_sc),
{name} AS (SELECT {gs}CASE WHEN max(tp_all) > 0 AND max(tn_all) > 0 THEN
  sum(CAST(pos AS DOUBLE) * (2.0 * (tn_all - fps) + neg)) / (2.0 * max(tp_all) * max(tn_all)) END AS auc
  FROM {name}_cc {gb})"""


def ctes_centroid_scores() -> str:
    return ctes_tfidf() + f""",
{LAB},
cn AS (SELECT count_if(label = 1) AS n_pos, count_if(label = 0) AS n_neg FROM lab),
cw AS (SELECT term_idx,
    coalesce(sum(CASE WHEN label = 1 THEN value ELSE 0.0 END) / nullif(max(n_pos), 0), 0.0)
  - coalesce(sum(CASE WHEN label = 0 THEN value ELSE 0.0 END) / nullif(max(n_neg), 0), 0.0) AS weight
  FROM tfidf JOIN lab USING (doc_id), cn GROUP BY term_idx),
cs AS (SELECT doc_id, sum(value * weight) AS s FROM tfidf JOIN cw USING (term_idx) GROUP BY doc_id),
cscores AS (SELECT r.doc_id, l.label, round(coalesce(cs.s, 0.0), 9) AS score
  FROM records r LEFT JOIN cs USING (doc_id) LEFT JOIN lab l USING (doc_id))"""
