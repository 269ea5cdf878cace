"""Person ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import col_of

LEGACY_DIGITS = 7
# Place of the digit that holds a UUID's variant.
VARIANT_AT = 20


def name_uuid(c: Column | str, namespace: uuid.UUID = uuid.NAMESPACE_DNS) -> Column:
    """Version-5 UUID of a text, computed in the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(col_of(c), "UTF-8")))
    grouped = F.regexp_replace(digest, "^(.{8})(.{4}).(.{3})(.{4})(.{12}).*$", "$1-$2-5$3-$4-$5")
    variant = F.translate(F.substring(grouped, VARIANT_AT, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.overlay(grouped, variant, VARIANT_AT)


def legacy_uuid(c: Column | str) -> Column:
    """Seven-digit ids become UUIDs, others stay."""
    value = col_of(c)
    return F.when(value.rlike(f"^[0-9]{{{LEGACY_DIGITS}}}$"), name_uuid(value)).otherwise(value)


def is_single_digit(c: Column | str) -> Column:
    return F.coalesce(col_of(c).rlike("^[0-9]$"), F.lit(False))
