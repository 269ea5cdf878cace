"""Street names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import col_of, strip

# Abbreviations spelt out inside a name (a last word is left alone).
STREET_WORDS = {
    "ST": "STREET",
    "AV": "AVENUE",
    "AVE": "AVENUE",
    "BLVD": "BOULEVARD",
    "RD": "ROAD",
    "PKWY": "PARKWAY",
    "PL": "PLACE",
    "TER": "TERRACE",
    "HWY": "HIGHWAY",
    "LN": "LANE",
    "SQ": "SQUARE",
    "DR": "DRIVE",
    "CTR": "CENTER",
    "LOOP": "LOOP",
    "CIR": "CIRCLE",
}
CITY = "New York, NY"


def clean_street(c: Column | str) -> Column:
    """Upper case, no dots, hyphens as blanks, single blanks, inner abbreviations spelt out."""
    name = F.replace(F.upper(col_of(c)), F.lit("."), F.lit(""))
    name = F.replace(name, F.lit("-"), F.lit(" "))
    name = strip(F.regexp_replace(name, r"(?U)\s+", " "))
    for short, full in STREET_WORDS.items():
        name = F.replace(name, F.lit(f" {short} "), F.lit(f" {full} "))
    return name


def _present(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit(""))


def build_address(on: Column | str, cross: Column | str, off: Column | str, city: str = CITY) -> Column:
    """'ON, AND CROSS, OFF, New York, NY' from the parts that exist; null if none does."""
    parts = F.concat_ws(", ", _present(on), F.concat(F.lit("AND "), _present(cross)), _present(off))
    return F.when(parts != "", F.concat(parts, F.lit(f", {city}")))


def fallback_address(on: Column | str, borough: Column | str) -> Column:
    return F.concat(F.coalesce(col_of(on), F.lit("")), F.lit(", "), F.coalesce(col_of(borough), F.lit("")))


def address_key(c: Column | str) -> Column:
    """Key under which two spellings of an address meet."""
    return F.upper(strip(c))
