"""Text column functions (FN1, FN17-FN21, FN24, PRJ1, PRJ2, FLT8).

All are plain ``Column -> Column`` compositions of built-ins, so they stay
inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# City spellings folded to one canonical name (matched after upper(trim(x))).
CITY_CANONICAL_NAMES: dict[str, str] = {
    "BANGALORE": "Bangalore",
    "BENGALURU": "Bangalore",
    "NEW DELHI": "Delhi",
    "DELHI": "Delhi",
    "BOMBAY": "Mumbai",
}
# Exact-match venue spelling replacements applied at ingest (case-sensitive).
INGEST_CITY_REPLACEMENTS: dict[str, str] = {
    "Bengaluru": "Bangalore",
    "New Delhi": "Delhi",
}
# Substrings that mark a cuisine list as Indian (matched on upper-cased text).
INDIAN_CUISINE_MARKERS: tuple[str, ...] = ("NORTH INDIAN", "SOUTH INDIAN", "INDIAN", "BIRYANI")
# Match types that count as knockout games (matched on lower(trim(x))).
KNOCKOUT_MATCH_TYPES: tuple[str, ...] = ("qualifier", "eliminator", "final")
# ---------------------------------------------------------------------------

# ASCII whitespace stripped by PRJ2 (space, tab, LF, VT, FF, CR).
WHITESPACE = r"[ \t\n\x0B\f\r]"


def standardise_city(c) -> Column:
    """FN1: fold known spellings, else first letter upper + rest lower.

    Not ``initcap``: "new york" must become "New york". NULL stays NULL.
    """
    c = as_col(c)
    key = F.upper(F.trim(c))
    trimmed = F.trim(c)
    out = None
    for spelling, canonical in CITY_CANONICAL_NAMES.items():
        cond = key == F.lit(spelling)
        out = F.when(cond, F.lit(canonical)) if out is None else out.when(cond, F.lit(canonical))
    rest = F.substring(trimmed, 2, 2147483647)
    return out.otherwise(F.concat(F.upper(F.substring(trimmed, 1, 1)), F.lower(rest)))


def strip_whitespace(c) -> Column:
    """Strip leading/trailing whitespace of any kind (pandas ``str.strip``).

    Spark's ``trim`` only removes spaces, so a regex is used (N5).
    """
    return F.regexp_replace(as_col(c), f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def blank_to_null(c) -> Column:
    """PRJ2: strip whitespace, then turn the empty string into NULL."""
    return F.nullif(strip_whitespace(c), F.lit(""))


def first_list_item(c, sep: str = ",") -> Column:
    """FN17: trimmed first item of a delimited list; NULL-safe, never raises.

    ``get`` (not ``[0]``) so that ANSI mode returns NULL instead of failing.
    """
    return F.trim(F.get(F.split(as_col(c), re.escape(sep)), 0))


def contains_any(c, needles: Iterable[str]) -> Column:
    """FLT8: OR of ``upper(coalesce(c,'')) LIKE '%NEEDLE%'``; never NULL."""
    text = F.upper(F.coalesce(as_col(c), F.lit("")))
    out = F.lit(False)
    for needle in needles:
        out = out | text.contains(needle.upper())
    return out


def is_indian_cuisine(c) -> Column:
    """FN18: cuisine list names any Indian cuisine."""
    return contains_any(c, INDIAN_CUISINE_MARKERS)


def in_folded(c, values: Iterable[str]) -> Column:
    """FN19: ``lower(trim(c)) IN values``, with NULL mapped to false."""
    return F.coalesce(F.lower(F.trim(as_col(c))).isin(list(values)), F.lit(False))


def is_knockout(c) -> Column:
    return in_folded(c, KNOCKOUT_MATCH_TYPES)


def pair_label(left, right, sep: str = " vs ") -> Column:
    """FN20: ``left || sep || right``; NULL if either side is NULL (concat, not concat_ws)."""
    return F.concat(as_col(left), F.lit(sep), as_col(right))


def text_to_bool(c) -> Column:
    """FN24: 'TRUE'/'FALSE' after strip + upper; anything else NULL."""
    key = F.upper(strip_whitespace(as_col(c).cast("string")))
    return F.when(key == "TRUE", F.lit(True)).when(key == "FALSE", F.lit(False))


def upper_trim(c) -> Column:
    """FN21: ``upper(trim(c))``."""
    return F.upper(F.trim(as_col(c)))


def replace_values(c, mapping: Mapping[str, str]) -> Column:
    """JN11: exact, case-sensitive value replacement; other values unchanged."""
    c = as_col(c)
    out = None
    for old, new in mapping.items():
        cond = c == F.lit(old)
        out = F.when(cond, F.lit(new)) if out is None else out.when(cond, F.lit(new))
    return c if out is None else out.otherwise(c)


# A word of a header: capitals with the small letters and digits after them, or these alone.
_HEADER_WORD = re.compile(r"[A-Z]+[a-z0-9]*|[a-z0-9]+")


def snake_case(name: str) -> str:
    """PRJ1: a header's words, lower-cased and joined by underscores (metadata only, on the driver)."""
    return "_".join(word.lower() for word in _HEADER_WORD.findall(name))


def snake_case_columns(df):
    """PRJ1 over a DataFrame: a pure rename, no data movement."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def clean_string_columns(df):
    """PRJ2 over every ``StringType`` column of ``df`` (single projection)."""
    from pyspark.sql.types import StringType

    return df.select(*[
        blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])
