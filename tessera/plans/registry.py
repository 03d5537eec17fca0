"""Registry of named queries: a Spark builder and, where the semantics are
expressible in SQL, the equivalent DuckDB oracle."""
from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict:
    # Importing the query modules fills the registry.
    from . import q_assembly, q_checks, q_eda, q_features, q_metrics, q_models, q_prep, q_preprocess, q_stream, q_validate  # noqa: F401
    return REGISTRY
