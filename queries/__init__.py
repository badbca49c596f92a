"""Queries over the test tables, each with the SQL it is checked against."""

from importlib import import_module

_MODULES = ("book", "profile", "binning", "screening", "encoding", "metrics", "descriptive", "models", "storage")


def load_all() -> None:
    """Import every query module, which fills the registry."""
    for name in _MODULES:
        import_module(f"queries.{name}")
