"""Every SQL-checked query equals its DuckDB oracle on the smallest scale factor."""

import hashlib
import math

import pandas as pd
import pytest

from __spark_entry__ import oracle_sql, queries

from .conftest import SMOKE

SLOW = {"learning_curve_bands", "threshold_report", "cv_metrics_from_scores", "doc_freq", "term_counts",
        "trial_params", "active_params", "shap_dots", "decision_path_relative"}


def _norm(v):
    if v is None or v is pd.NA:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):  # pandas shows a NULL in a number column as NaN
            return "NULL"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return repr(round(v + 0.0, 6))
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest(), len(rows)


KEYS = sorted(k for k in oracle_sql() if k not in SLOW)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    got = queries()[key](spark, SMOKE).toPandas()
    want = duck.sql(oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _digest(got) == _digest(want)


def test_every_query_has_a_callable():
    q = queries()
    assert set(oracle_sql()) <= set(q)
    assert len(q) >= 80
