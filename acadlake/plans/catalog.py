"""Registry of every query exposed to the driver (name -> builder, name -> oracle SQL)."""

from __future__ import annotations

import importlib

MODULES = (
    "acadlake.plans.catalog_products",
    "acadlake.plans.catalog_ops",
    "acadlake.plans.catalog_maint",
    "acadlake.plans.catalog_quality",
    "acadlake.plans.catalog_io",
)


def _modules():
    return [importlib.import_module(m) for m in MODULES]


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _modules():
        out.update(m.ORACLES)
    return out
