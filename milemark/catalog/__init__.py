"""Every operator as a named query over the given tables, most with an equivalent SQL check."""

from importlib import import_module

MODULES = ["cleaning", "scalars", "aggregates", "metrics", "ingest", "windows", "layers", "learning", "closed_forms"]


def load() -> None:
    """Register the queries of all catalog modules."""
    for module in MODULES:
        import_module(f"{__name__}.{module}")
