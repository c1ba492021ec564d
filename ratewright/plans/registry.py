"""Registered queries and their DuckDB SQL."""

from ratewright.plans import q_aggregate, q_evaluate, q_joins, q_models, q_quality, q_scalar, q_windows  # noqa: F401
from ratewright.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
