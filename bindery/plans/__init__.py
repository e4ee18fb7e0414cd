"""Queries that put the operators to work on the star-schema tables."""

import importlib

MODULES = ("scalars", "rows", "joins", "audit", "files", "models", "flows")


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"bindery.plans.{name}")
