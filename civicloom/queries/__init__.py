"""Registered queries: a module for each family, each with QUERIES and ORACLE."""

from __future__ import annotations

from types import ModuleType


def families() -> list[ModuleType]:
    """The modules of this package that register queries."""
    from civicloom.queries import civic, data_problems, reference

    return [reference, civic, data_problems]
