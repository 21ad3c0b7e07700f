"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from hardwood.catalogue.registry import REGISTRY, Query

MODULES = ["cleaning", "pages", "merging", "features", "scaling", "models", "evaluation", "subscriptions", "pipelines", "files"]


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"hardwood.catalogue.{module}")
    return REGISTRY
