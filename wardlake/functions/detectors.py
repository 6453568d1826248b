"""Entity detectors: every hit in a text value with a score in hundredths.

The scores are ours. They are integers so that sums do not depend on the order
in which Spark merges partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns stay in the subset on which Java regex and RE2 agree.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# Enough to say whether there is an address; without the leading repetition the
# search does not rescan every word of a text.
EMAIL_PRESENT = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# International with a country code, or national with ten digits and separators.
_NATIONAL = r"(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}"
PHONE = r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4}[0-9]*|[0-9-]*" + _NATIONAL + "[0-9-]*"
PHONE_VALID = r"^(?:\+[0-9 ().-]+|(?:1-)?" + _NATIONAL + ")$"
PHONE_DIGITS = (7, 15)
# Says whether there is a number; without the leading repetition.
PHONE_PRESENT = r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,4}|(?:^|[^0-9-])" + _NATIONAL + "(?:[^0-9-]|$)"
# Digits, singly separated by a space or hyphen or not at all.
DIGIT_RUN = r"[0-9](?:[ -]?[0-9]){12,}"
CARD_DIGITS = (13, 19)
# RE2 has no look-around, so one more character on each side tells where the number ends.
SSN = r"[0-9-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9-]*"
SSN_VALID = r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
# Five and more numbers are one hit, which is no valid address.
IP = r"[0-9]+(?:\.[0-9]+){3,}"
IP_VALID = (
    r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
)
SECRET = r"[0-9a-f]{40,}"
SECRET_DIGITS = (40, 40)


def _found(col: Column, pattern: str) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))


def _found_with(col: Column, mark: str, pattern: str) -> Column:
    """Hits of a pattern that needs a rare character; most values fail the byte search."""
    none = F.array().cast("array<string>")
    return F.when(F.contains(col, F.lit(mark)), _found(col, pattern)).when(col.isNotNull(), none)


def _scored(hits: Column, score) -> Column:
    return F.transform(hits, lambda h: F.struct(h.alias("hit"), score(h).cast("int").alias("score")))


def _luhn(text: Column) -> Column:
    return F.call_function("luhn_check", text)


def _in_range(hit: Column, lengths: tuple[int, int]) -> Column:
    return F.char_length(hit).between(*lengths)


def entity_hits(col: Column, entity_type: str, card_digits: tuple[int, int] = CARD_DIGITS,
                secret_digits: tuple[int, int] = SECRET_DIGITS) -> Column:
    """``ARRAY<STRUCT<hit STRING, score INT>>`` of one entity type in a value.

    Card numbers are given without their separators. ``card_digits`` and
    ``secret_digits`` are the least and most digits that still count as a hit.
    """
    if entity_type == "EMAIL":
        return _scored(_found_with(col, "@", EMAIL), lambda h: F.lit(95))
    if entity_type == "PHONE":
        valid = lambda h: h.rlike(PHONE_VALID) & _in_range(F.regexp_replace(h, "[^0-9]", ""), PHONE_DIGITS)
        none = F.array().cast("array<string>")
        found = F.when(F.contains(col, F.lit("+")) | col.rlike("[0-9]{3}[-. ][0-9]{4}"), _found(col, PHONE)).when(col.isNotNull(), none)
        return _scored(F.filter(found, valid), lambda h: F.lit(80))
    if entity_type == "CREDIT_DEBIT_NUMBER":
        bare = F.transform(_found(col, DIGIT_RUN), lambda h: F.regexp_replace(h, "[ -]", ""))
        runs = F.filter(bare, lambda h: _in_range(h, card_digits))
        return _scored(runs, lambda h: F.when(_luhn(h), 99).otherwise(20))
    if entity_type == "SSN":
        return _scored(F.filter(_found(col, SSN), lambda h: h.rlike(SSN_VALID)), lambda h: F.lit(85))
    if entity_type == "IP_ADDRESS":
        return _scored(_found(col, IP), lambda h: F.when(h.rlike(IP_VALID), 90).otherwise(10))
    if entity_type == "SECRET_TOKEN":
        keys = F.filter(_found(col, SECRET), lambda h: _in_range(h, secret_digits))
        return _scored(keys, lambda h: F.lit(90))
    raise ValueError(f"unknown entity type {entity_type!r}")


ENTITY_TYPES = ("EMAIL", "PHONE", "CREDIT_DEBIT_NUMBER", "SSN", "IP_ADDRESS", "SECRET_TOKEN")
