"""All registered queries."""

from __future__ import annotations

from checks import monthly, primitives, scorecard, weekly
from checks.registry import Query

MODULES = (monthly, weekly, scorecard, primitives)


def queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for m in MODULES:
        clash = merged.keys() & m.reg.queries.keys()
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        merged |= m.reg.queries
    return merged


def oracle_sql() -> dict[str, str]:
    merged: dict[str, str] = {}
    for m in MODULES:
        merged |= m.reg.oracle
    return merged
