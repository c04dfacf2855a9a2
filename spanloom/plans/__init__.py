"""Queries over the shared tables; importing a module registers its queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ["relational", "sequence", "temporal", "vector", "evaluation", "text", "maintenance", "annotation", "assignment", "audit", "tables", "reports"]


def load() -> None:
    """Registers all queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
