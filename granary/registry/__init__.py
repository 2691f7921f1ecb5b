"""Every operator as a named query over the given tables, with the SQL that checks it.

Each query reads whole tables.  Where the operator needs food columns that the given tables lack,
raw text columns are derived from them by plain SQL expressions that both engines understand.
"""

from __future__ import annotations

from granary.registry import (  # noqa: F401
    bundles,
    duplicates,
    files,
    increments,
    joins,
    loading,
    quality,
    reshape,
    text,
)
from granary.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
