"""DuckDB SQL oracles for the score-table analytics (plain windows; oracle only)."""

from __future__ import annotations

from screensift.plans.sql_text import r6
from screensift.sources.tables import SQL_PROXY_SCORES


def _pg(groups):
    return ("PARTITION BY " + ", ".join(groups)) if groups else ""


def _gsel(groups):
    return "".join(f"{g}, " for g in groups)


def ctes_cum(groups=(), src="scores") -> str:
    """sc (distinct scores) and cc (running tps/fps, P, N, idx, n) per group."""
    g = list(groups)
    pg = _pg(g)
    gb = ", ".join(g + ["score"])
    return f"""sc AS (SELECT {_gsel(g)}score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
  FROM {src} GROUP BY {gb}),
cc AS (SELECT {_gsel(g)}score, pos, neg,
  CAST(sum(pos) OVER ({pg} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tps,
  CAST(sum(neg) OVER ({pg} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fps,
  CAST(sum(pos) OVER ({pg}) AS BIGINT) AS P, CAST(sum(neg) OVER ({pg}) AS BIGINT) AS N,
  row_number() OVER ({pg} ORDER BY score DESC) AS idx, count(*) OVER ({pg}) AS n_rows
  FROM sc)"""


def roc_sql(groups=(), thin=True, src_ctes=SQL_PROXY_SCORES) -> str:
    g = list(groups)
    pg = _pg(g)
    keep = "TRUE"
    extra = ""
    if thin:
        extra = f""",
th AS (SELECT *, lag(fps) OVER ({pg} ORDER BY score DESC) AS fp_prev, lead(fps) OVER ({pg} ORDER BY score DESC) AS fp_next,
  lag(tps) OVER ({pg} ORDER BY score DESC) AS tp_prev, lead(tps) OVER ({pg} ORDER BY score DESC) AS tp_next FROM cc)"""
        keep = "idx = 1 OR idx = n_rows OR fp_next - 2 * fps + fp_prev <> 0 OR tp_next - 2 * tps + tp_prev <> 0"
    src = "th" if thin else "cc"
    return f"""WITH {src_ctes},
{ctes_cum(g)}{extra},
roc AS (
  SELECT {_gsel(g)}CAST(score AS DOUBLE) AS threshold, fps, tps, P, N FROM {src} WHERE {keep}
  UNION ALL
  SELECT {_gsel(g)}CAST('inf' AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), P, N FROM cc WHERE idx = 1)"""


def roc_select(groups=()) -> str:
    return f"""SELECT {_gsel(groups)}{r6('threshold')} AS threshold, fps, tps,
  {r6('CAST(fps AS DOUBLE) / N')} AS fpr, {r6('CAST(tps AS DOUBLE) / P')} AS tpr FROM roc"""


def metrics_cols(tp="tp", tn="tn", fp="fp", fn="fn") -> str:
    tpr = f"(CASE WHEN {tp} + {fn} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fn}) ELSE 0.0 END)"
    fpr = f"(CASE WHEN {fp} + {tn} > 0 THEN CAST({fp} AS DOUBLE) / ({fp} + {tn}) ELSE 0.0 END)"
    prec = f"(CASE WHEN {tp} + {fp} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fp}) ELSE 0.0 END)"
    den = f"(16.0 * {prec} + {tpr})"
    return f"""{r6(f'CAST({tp} + {tn} AS DOUBLE) / ({tp} + {tn} + {fp} + {fn})')} AS accuracy,
  {r6(f'0.5 * ({tpr} + (1.0 - {fpr}))')} AS balanced_accuracy, {r6(tpr)} AS recall, {r6(prec)} AS precision,
  {r6(f'1.0 - {fpr}')} AS specificity, {r6(fpr)} AS fpr,
  {r6(f'17.0 * {prec} * {tpr} / (CASE WHEN {den} <> 0 THEN {den} ELSE 1.0 END)')} AS f4"""


def density_ctes(groups=("label",), src="scores", grid=500) -> str:
    g = list(groups)
    on = " AND ".join(f"g.{c} = p.{c}" for c in g)
    return f"""st AS (SELECT {_gsel(g)}min(score) AS lo, max(score) AS hi, count(*) AS n,
    stddev_samp(score) * pow(count(*), -0.2) AS bw, (max(score) - min(score)) / {float(grid)} AS step
  FROM {src} GROUP BY {", ".join(g)}),
pts AS (SELECT {_gsel(g)}score AS v, count(*) AS w FROM {src} GROUP BY {", ".join(g + ["score"])}),
grid AS (SELECT {_gsel(g)}lo, step, n, bw, unnest(generate_series(0, {grid - 1})) AS i FROM st WHERE step > 0),
dens AS (
  SELECT {", ".join("g." + c for c in g)}, g.i, g.lo + g.i * g.step AS x,
    sum(p.w * exp(-0.5 * ((g.lo + g.i * g.step - p.v) / g.bw) * ((g.lo + g.i * g.step - p.v) / g.bw)))
      / (g.n * g.bw * sqrt(2 * pi())) AS density
  FROM grid g JOIN pts p ON {on}
  GROUP BY {", ".join("g." + c for c in g)}, g.i, g.lo, g.step, g.n, g.bw)"""
