"""Small shared helpers for column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping, default=None) -> Column:
    """``CASE c WHEN k THEN v ... ELSE default END`` from a small literal mapping."""
    c = as_col(c)
    out = None
    for key, value in mapping.items():
        cond = c == F.lit(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out
