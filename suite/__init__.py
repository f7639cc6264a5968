"""Queries over the driver tables, each with the SQL that gives the same rows."""

from importlib import import_module


def load_all() -> None:
    for part in ("relational", "costing", "quality", "export", "scalars"):
        import_module(f"suite.{part}")
