"""Cleaning of text columns. ``trim`` takes off plain spaces only, not tabs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value. \z, not $: in Java $ would also accept a newline after the address.
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+\z"


def clean_text(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def clean_country(value: Column) -> Column:
    """Trimmed upper-case country code, NULL when nothing is left."""
    return F.nullif(F.upper(F.trim(value)), F.lit(""))


def clean_currency(value: Column) -> Column:
    return F.upper(F.trim(value))


def clean_label(value: Column) -> Column:
    """Trimmed lower-case label, for statuses and plan names."""
    return F.lower(F.trim(value))


def is_blank(value: Column) -> Column:
    return clean_text(value).isNull()


def is_invalid_email(value: Column) -> Column:
    """True when the address, taken as it is and not trimmed, is missing or malformed."""
    return value.isNull() | ~value.rlike(EMAIL_PATTERN)
