"""All registered queries."""

from __future__ import annotations

from panelwright.plans import (  # noqa: F401  (registration by import)
    catalog_models,
    catalog_panel,
    catalog_scoring,
    catalog_stats,
)
from panelwright.plans.registry import REGISTRY


def queries() -> dict:
    return {name: r.run for name, r in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: r.sql for name, r in REGISTRY.items() if r.sql}


def coverage() -> dict[str, list[str]]:
    """Blueprint id to query names."""
    out: dict[str, list[str]] = {}
    for name, r in REGISTRY.items():
        for ident in r.covers.split():
            out.setdefault(ident, []).append(name)
    return dict(sorted(out.items()))
