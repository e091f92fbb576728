"""Operators for preparing training data, with their queries. Nothing else in the library imports this subpackage."""

import importlib
import pkgutil


def query_modules() -> list:
    """The modules that hold queries: each has QUERIES and SQL."""
    return [importlib.import_module(f"{__name__}.{m.name}") for m in pkgutil.iter_modules(__path__) if m.name.startswith("queries_")]
