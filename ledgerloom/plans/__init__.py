"""Runnable queries over the given tables, grouped by operator family."""

from importlib import import_module

_MODULES = (
    "shaping_queries",
    "join_queries",
    "aggregate_queries",
    "window_queries",
    "change_queries",
    "quality_queries",
    "source_queries",
    "sink_queries",
    "function_queries",
    "domain_queries",
    "stream_queries",
)


def load_all() -> None:
    """Import every query module once, which registers its queries."""
    for name in _MODULES:
        import_module(f"ledgerloom.plans.{name}")
