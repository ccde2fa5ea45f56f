"""Imports every query module so the registry is complete."""

from screensift.plans import q_explain, q_io, q_jobs, q_metrics, q_models, q_search, q_splits, q_text  # noqa: F401
from screensift.plans.registry import ORACLES, QUERIES  # noqa: F401
