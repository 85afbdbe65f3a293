"""Registered queries: every operator of the inventory as ``(spark, sf_dir)
-> DataFrame`` plus, where SQL can say it, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from sluice.plans import params as P  # noqa: F401,E402

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    # Import for the registration side effect.
    from sluice.plans import (  # noqa: F401
        q_aggregate,
        q_basic,
        q_sources,
        q_time_state,
        q_windows,
    )
    from sluice.plans import q_stateful_tws  # noqa: F401  (reuses the SQL above)

    return REGISTRY
