"""The queries and SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

MODULES = ("quality_rules", "rule_ensemble", "simhash", "mixing", "decontamination", "tokens", "substring", "html_extract", "lm_scoring", "secrets")

#: All are imported with this module, so that what is missing shows at once.
LOADED = [import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict[str, Callable]:
    return {name: f for m in LOADED for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in LOADED for name, sql in m.SQL.items()}
