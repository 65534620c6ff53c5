"""Key and lookup column functions (FN26, JN9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col

# Fixed value: placeholder that stands in for NULL fields inside a surrogate key
# (the published dbt_utils 1.x form of generate_surrogate_key).
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(fields: Sequence) -> Column:
    """FN26: ``md5(f1 || '-' || f2 ...)`` with NULL fields replaced by a placeholder."""
    parts = [F.coalesce(as_col(f).cast("string"), F.lit(SURROGATE_KEY_NULL)) for f in fields]
    return F.md5(F.concat_ws("-", *parts))


def lookup(c, mapping: Mapping, default=None, case_insensitive: bool = False) -> Column:
    """JN9 / JN10: dictionary lookup through a map literal, optional default.

    The map is a compile-time constant (no join, no broadcast); missing keys
    give ``default`` (NULL when not given). ``case_insensitive`` lowers both
    the key column and the map keys.
    """
    key = as_col(c)
    items = mapping.items()
    if case_insensitive:
        key = F.lower(key)
        items = [(str(k).lower(), v) for k, v in items]
    m = F.create_map(*[x for k, v in items for x in (F.lit(k), F.lit(v))])
    found = F.try_element_at(m, key)
    return found if default is None else F.coalesce(found, F.lit(default))
