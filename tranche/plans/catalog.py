"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["q_portfolio", "q_quality", "q_features", "q_metrics", "q_models", "q_extra", "q_cleaner", "q_survival"]


def load() -> tuple[dict, dict]:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return QUERIES, ORACLE
