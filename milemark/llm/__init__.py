"""Operators for preparing training text, and their queries. Nothing else in the library imports this package."""

from importlib import import_module


def load():
    """Register the queries of this package, and the pipeline's; returns the registry."""
    registry = import_module(f"{__name__}.registry")
    import_module(f"{__name__}.queries")
    import_module("corpus_pipeline")
    return registry
