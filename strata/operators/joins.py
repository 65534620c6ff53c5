"""Equi-joins (JN1-JN7, SET2).

No join strategy is forced here. Static planning broadcasts a side only when
its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-checks the real shuffle size at runtime
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) before converting a
sort-merge join; anything larger stays a shuffle join, with AQE splitting
skewed partitions. So every broadcast is behind a measured size bound.

Sides that are only probed for key existence are reduced to distinct keys
first: that aggregation runs map-side (partial), so a key repeated across a
third of the table reaches the exchange once per map task, and the join
itself can never fan out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(keys) -> list[tuple[str, str]]:
    """Accept ``['k']`` or ``[('left_k', 'right_k')]``."""
    out = []
    for k in keys:
        out.append((k, k) if isinstance(k, str) else (k[0], k[1]))
    return out


def _right_keys_as_left(right: DataFrame, pairs, where: Column | None = None) -> DataFrame:
    """Project ``right`` onto its key columns, renamed to the left names."""
    if where is not None:
        right = right.where(where)
    return right.select(*[F.col(r).alias(l) for l, r in pairs])


def left_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """JN1: LEFT equi-join on one or more keys; right key columns are dropped."""
    pairs = _pairs(keys)
    r = right
    for l, rr in pairs:
        if l != rr:
            r = r.withColumnRenamed(rr, l)
    names = [l for l, _ in pairs]
    extra = [c for c in r.columns if c not in names]
    return left.join(r, names, "left").select(*left.columns, *extra)


def anti_join(left: DataFrame, right: DataFrame, keys, right_where: Column | None = None,
              distinct_right: bool = True) -> DataFrame:
    """JN2 / JN5 / SET2: rows of ``left`` with no key match in ``right``.

    Keeps duplicates of ``left`` (unlike EXCEPT). SQL '=' semantics: a NULL
    key never matches, so NULL-keyed left rows are kept.

    The right side is reduced to distinct keys first. AQE can split a skewed
    *left* partition of an anti join but never the right (build) side, so a
    right key repeated across a third of the table must be pre-reduced
    map-side; the distinct's exchange is the one the join needs anyway.
    """
    pairs = _pairs(keys)
    right_keys = _right_keys_as_left(right, pairs, right_where)
    if distinct_right:
        right_keys = right_keys.distinct()
    return left.join(right_keys, [l for l, _ in pairs], "left_anti").select(*left.columns)


def semi_join(left: DataFrame, right: DataFrame, keys, right_where: Column | None = None) -> DataFrame:
    """Rows of ``left`` with at least one key match in ``right`` (no fan-out).

    The right side is reduced to distinct keys first (partial aggregation),
    which usually makes it small enough for AQE to broadcast; if it is not,
    the sort-merge fallback still splits a skewed left key (AQE skew join).
    """
    pairs = _pairs(keys)
    right_keys = _right_keys_as_left(right, pairs, right_where).distinct()
    return left.join(right_keys, [l for l, _ in pairs], "left_semi").select(*left.columns)


def exists_flag(left: DataFrame, right: DataFrame, keys, flag: str,
                right_where: Column | None = None) -> DataFrame:
    """JN3 / JN4: add boolean ``flag`` = EXISTS(matching right row [and predicate]).

    Right is reduced to distinct keys (map-side partial aggregation), then
    left-joined: one output row per left row, never a fan-out. NULL keys get
    false, like a correlated EXISTS with '='.
    """
    pairs = _pairs(keys)
    names = [l for l, _ in pairs]
    marks = (_right_keys_as_left(right, pairs, right_where)
             .where(_all_not_null(names))
             .groupBy(*names).agg(F.lit(True).alias(flag)))
    joined = left.join(marks, names, "left")
    return joined.select(*left.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def _all_not_null(names: Sequence[str]) -> Column:
    cond = None
    for n in names:
        c = F.col(n).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def orphans(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """JN7 / DQ4: child rows whose non-NULL foreign key has no parent row."""
    pairs = _pairs(keys)
    names = [l for l, _ in pairs]
    return anti_join(child.where(_all_not_null(names)), parent, pairs)


def coverage_gap(child: DataFrame, reference: DataFrame, keys, count_name: str,
                 group_cols: Sequence[str] | None = None) -> DataFrame:
    """JN2 + AGG1 + SRT1 (MD12): per group, child rows with no reference row.

    Groups default to the join keys (the reference report groups by the same
    (city, date) it joins on).

    ``LEFT JOIN ... WHERE right IS NULL GROUP BY`` is written as a left-anti
    join followed by a partial/final hash aggregate, sorted by the count
    descending then the keys (the keys make the order total).
    """
    pairs = _pairs(keys)
    names = list(group_cols) if group_cols else [l for l, _ in pairs]
    gaps = anti_join(child, reference, pairs)
    counted = gaps.groupBy(*names).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 0)
    return counted.orderBy(F.col(count_name).desc(), *[F.col(n).asc_nulls_first() for n in names])
