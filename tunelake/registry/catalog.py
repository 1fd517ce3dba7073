"""Every registered query, gathered from the modules that define them."""

from __future__ import annotations

from tunelake.registry import code_eval, data_prep, exec_eval, hooks, perf_logs, sql_eval, tokens_splits, weights_q  # noqa: F401
from tunelake.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
