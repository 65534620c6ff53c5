"""Data-quality checks (DQ1-DQ14) evaluated as few passes as possible.

A check either describes *failing rows* by a predicate (not_null,
accepted_values, between, singular expression tests) or needs its own
grouping (unique, unique combination, relationships, proportion of unique
values). All predicate checks of one table -- plus the row-count check -- are
folded into ONE aggregate of ``count_if`` columns, i.e. one scan and a single
one-row partial/final aggregate, however many checks there are. Grouped
checks each cost one shuffle of just their key columns.

NULL rules follow the published test packages: accepted_values and between
pass NULL; unique ignores NULL; not_null fails it. A predicate that is NULL
(three-valued) does not count as a failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.aggregates import duplicate_keys
from strata.operators.joins import orphans


@dataclass
class Check:
    name: str
    kind: str  # "row" | "unique" | "relationship" | "row_count" | "proportion_unique"
    failing: Column | None = None          # row checks: predicate of a failing row
    keys: Sequence[str] = ()                # unique / relationship / proportion
    parent: DataFrame | None = None         # relationship
    parent_keys: Sequence[str] = ()
    low: float | None = None                # row_count / proportion bounds
    high: float | None = None
    severity: str = "error"
    extra: dict = field(default_factory=dict)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def not_null(col: str, name: str | None = None) -> Check:
    """DQ1."""
    return Check(name or f"not_null_{col}", "row", failing=_c(col).isNull())


def accepted_values(col: str, values: Sequence, name: str | None = None) -> Check:
    """DQ3: values outside the list fail; NULL passes."""
    return Check(name or f"accepted_values_{col}", "row",
                 failing=_c(col).isNotNull() & ~_c(col).isin(list(values)))


def between(col: str, low=None, high=None, row_condition: Column | str | None = None,
            name: str | None = None) -> Check:
    """DQ5: ``low <= col <= high`` among rows meeting ``row_condition``."""
    c = _c(col)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= F.lit(low))
    if high is not None:
        ok = ok & (c <= F.lit(high))
    cond = c.isNotNull()
    if row_condition is not None:
        cond = cond & (F.expr(row_condition) if isinstance(row_condition, str) else row_condition)
    return Check(name or f"between_{col}", "row", failing=cond & ~ok)


def expression(name: str, failing: Column | str) -> Check:
    """DQ10-DQ12: singular test; ``failing`` selects offending rows."""
    return Check(name, "row", failing=F.expr(failing) if isinstance(failing, str) else failing)


def unique(cols: Sequence[str] | str, name: str | None = None) -> Check:
    """DQ2 / DQ7 / DQ8: duplicated non-NULL key values fail (one per value)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return Check(name or f"unique_{'_'.join(cols)}", "unique", keys=cols)


def relationships(cols, parent: DataFrame, parent_cols, name: str | None = None) -> Check:
    """DQ4: child rows with a non-NULL key absent from ``parent``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    parent_cols = [parent_cols] if isinstance(parent_cols, str) else list(parent_cols)
    return Check(name or f"relationships_{'_'.join(cols)}", "relationship", keys=cols,
                 parent=parent, parent_keys=parent_cols)


def row_count_between(low=None, high=None, name: str = "row_count_between") -> Check:
    """DQ6: the table's row count within bounds (one failure if not)."""
    return Check(name, "row_count", low=low, high=high)


def proportion_unique_between(col: str, low: float, high: float, name: str | None = None) -> Check:
    """DQ9 / AGG3: distinct / non-NULL count within bounds (one failure if not)."""
    return Check(name or f"proportion_unique_{col}", "proportion_unique", keys=[col], low=low, high=high)


def _bounded_fail(value: Column, low, high) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < F.lit(low))
    if high is not None:
        bad = bad | (value > F.lit(high))
    return F.coalesce(bad, F.lit(False))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a single check returns (what the test query would show)."""
    if check.kind == "row":
        return df.where(F.coalesce(check.failing, F.lit(False)))
    if check.kind == "unique":
        return duplicate_keys(df, check.keys)
    if check.kind == "relationship":
        return orphans(df, check.parent, list(zip(check.keys, check.parent_keys)))
    raise ValueError(f"{check.kind} checks have no row-level output")


def run_checks(df: DataFrame, checks: Sequence[Check], table: str | None = None) -> DataFrame:
    """Evaluate ``checks`` on ``df``: one row per check with its failure count.

    Output columns: ``check_name``, ``failing_rows`` (long), ``status``
    ('pass' or the check's severity).
    """
    parts: list[DataFrame] = []
    row_checks = [c for c in checks if c.kind in ("row", "row_count", "proportion_unique")]
    if row_checks:
        aggs = []
        for c in row_checks:
            if c.kind == "row":
                aggs.append(F.count_if(F.coalesce(c.failing, F.lit(False))).alias(c.name))
                continue
            value = F.count(F.lit(1))
            if c.kind == "proportion_unique":
                col = F.col(c.keys[0])
                value = F.try_divide(F.count_distinct(col).cast("double"), F.count(col).cast("double"))
            aggs.append(F.when(_bounded_fail(value, c.low, c.high), F.lit(1)).otherwise(F.lit(0))
                        .cast("long").alias(c.name))
        one_pass = df.agg(*aggs)
        parts.append(one_pass.unpivot([], [c.name for c in row_checks], "check_name", "failing_rows"))
    for c in checks:
        if c.kind in ("unique", "relationship"):
            n = failing_rows(df, c).agg(F.count(F.lit(1)).alias("failing_rows"))
            parts.append(n.select(F.lit(c.name).alias("check_name"), "failing_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    severity = F.create_map(*[x for c in checks for x in (F.lit(c.name), F.lit(c.severity))])
    out = out.select("check_name", F.col("failing_rows").cast("long").alias("failing_rows"),
                     F.when(F.col("failing_rows") > 0, F.try_element_at(severity, F.col("check_name")))
                     .otherwise(F.lit("pass")).alias("status"))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out
