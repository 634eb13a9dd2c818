"""Column rules for text that arrives from forms, files and other systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an address, a phone number and a numeric id.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_DIGITS = (9, 15)
NUMERIC_ID_PATTERN = r"^\d+$"


def blank_to_null(text: Column) -> Column:
    """Strip spaces at both ends; what is then empty becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def proper_name(text: Column) -> Column:
    """One space between words, each word capitalised."""
    return F.initcap(F.regexp_replace(text, r"\s+", " "))


def email_or_null(text: Column) -> Column:
    address = F.lower(text)
    return F.when(address.rlike(EMAIL_PATTERN), address)


def phone_or_null(text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(F.length(digits).between(*PHONE_DIGITS), digits)


def id_or_null(text: Column) -> Column:
    """A string of digits as a long; anything else, also one too long to fit, is NULL."""
    return F.when(text.rlike(NUMERIC_ID_PATTERN), text.try_cast("bigint"))


def time_or_null(text: Column) -> Column:
    return F.try_to_timestamp(text)


def truth(text: Column) -> Column:
    """True for the word "true" in any case, False for all else including NULL."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def unset(text: Column) -> Column:
    """Whether a marker column is empty: NULL, blank or the word "null"."""
    return text.isNull() | (F.trim(text) == "") | (F.lower(text) == "null")
