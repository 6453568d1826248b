"""The ten masking levels as ``Column -> Column`` functions.

Each function needs the column's Spark type, so the output type is known when
the plan is built. NULL stays NULL except for the constant levels.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The masking level codes.
NO_MASK = 10000
FULL = 10001
EMAIL = 10002
LAST_FOUR = 10003
CONSTANT = 10004
NULL = 10005
HASH = 10006
EMAIL_HASH = 10007
LAST_FOUR_HASH = 10008
CONSTANT_DATE = 10009

LEVELS = range(NO_MASK, CONSTANT_DATE + 1)

# When one column carries several tags, the leftmost of these levels wins.
STRICTEST_FIRST = (
    NULL, CONSTANT, CONSTANT_DATE, FULL, HASH,
    LAST_FOUR_HASH, EMAIL_HASH, LAST_FOUR, EMAIL, NO_MASK,
)

TEXT_LEVELS = frozenset({FULL, EMAIL, LAST_FOUR, HASH, EMAIL_HASH, LAST_FOUR_HASH})


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def stars(col: Column) -> Column:
    """One ``*`` for every character of the value."""
    return F.repeat(F.lit("*"), F.char_length(col))


def email_domain(col: Column) -> Column:
    at_sign = F.contains(col, F.lit("@"))
    domain = F.substring_index(col, "@", -1)
    return F.when(at_sign, F.concat(F.lit("****@"), domain)).otherwise(stars(col))


def _prefix(col: Column) -> Column:
    return F.substring(col, F.lit(1), F.char_length(col) - 4)


def last_four(col: Column) -> Column:
    starred = F.regexp_replace(_prefix(col), "[A-Za-z0-9]", "*")
    shown = F.concat(starred, F.right(col, F.lit(4)))
    return F.when(F.char_length(col) <= 4, stars(col)).otherwise(shown)


def hashed(col: Column, salt: str = "") -> Column:
    return F.sha2(F.concat(F.lit(salt), col) if salt else col, 256)


def email_hash(col: Column, salt: str = "") -> Column:
    at_sign = F.contains(col, F.lit("@"))
    local = F.substring(col, F.lit(1), F.char_length(col) - F.char_length(F.substring_index(col, "@", -1)) - 1)
    both = F.concat(hashed(local, salt), F.lit("@"), F.substring_index(col, "@", -1))
    return F.when(at_sign, both).otherwise(hashed(col, salt))


def last_four_hash(col: Column, salt: str = "") -> Column:
    both = F.concat(hashed(_prefix(col), salt), F.right(col, F.lit(4)))
    return F.when(F.char_length(col) <= 4, hashed(col, salt)).otherwise(both)


def _constant(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("*")
    if isinstance(dtype, T.NumericType):
        return F.lit(1).cast(dtype)
    if is_temporal(dtype):
        return F.lit(dt.date(2000, 1, 1)).cast(dtype)
    return F.lit(None).cast(dtype)


def _constant_date(dtype: T.DataType) -> Column:
    if is_temporal(dtype):
        return F.lit(dt.date(9999, 12, 31)).cast(dtype)
    return F.lit(None).cast(dtype)


def mask(col: Column, dtype: T.DataType, level: int | None, *, salt: str = "",
         on_nonstring: str = "cast") -> Column:
    """Apply one masking level; a missing level hides the value completely."""
    if level is None or level == NULL:
        return F.lit(None).cast(dtype)
    if level not in LEVELS:
        raise ValueError(f"masking level {level} is not in {LEVELS.start}-{LEVELS.stop - 1}")
    if level == NO_MASK:
        return col
    if level == CONSTANT:
        return _constant(dtype)
    if level == CONSTANT_DATE:
        return _constant_date(dtype)
    if not isinstance(dtype, T.StringType):
        if on_nonstring == "null":
            return F.lit(None).cast(dtype)
        if on_nonstring != "cast":
            raise ValueError("on_nonstring is 'cast' or 'null'")
        col = col.cast("string")
    if level == FULL:
        return stars(col)
    if level == EMAIL:
        return email_domain(col)
    if level == LAST_FOUR:
        return last_four(col)
    if level == HASH:
        return hashed(col, salt)
    if level == EMAIL_HASH:
        return email_hash(col, salt)
    return last_four_hash(col, salt)
