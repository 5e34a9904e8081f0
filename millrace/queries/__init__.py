"""Registered queries by area; :func:`load_all` imports them all."""

from importlib import import_module

AREAS = ["relational", "aggregates", "windows", "changes", "quality", "metrics", "features", "scalars", "governance", "monitoring", "texts", "analytics", "files", "streams"]


def load_all() -> None:
    for area in AREAS:
        import_module(f"millrace.queries.{area}")
