"""Numbers held as text, totals, severity, ages, rates, grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import UNKNOWN, col_of

# The four injured and four killed counts, snake and spaced spelling.
PARTIES = ("persons", "pedestrians", "cyclist", "motorist")
KILLED_WEIGHT = 5


def to_int(c: Column | str) -> Column:
    """Whole number of a text or number, else null.

    Text is rounded half up, a floating number half to even.
    """
    value = col_of(c)
    number = value.try_cast("double")
    return F.when(F.typeof(value) == "string", F.round(number)).otherwise(F.bround(number)).try_cast("bigint")


def to_int0(c: Column | str) -> Column:
    """As `to_int`, with 0 for what is no number."""
    return F.coalesce(to_int(c), F.lit(0).cast("bigint"))


def severity(injured: Column | str, killed: Column | str) -> Column:
    return col_of(injured) + F.lit(KILLED_WEIGHT) * col_of(killed)


def age_band(c: Column | str) -> Column:
    """0-18, 19-30, 31-50, 51+ or Unknown."""
    age = to_int(c)
    return (
        F.when(age <= 18, "0-18")
        .when(age <= 30, "19-30")
        .when(age <= 50, "31-50")
        .when(age > 50, "51+")
        .otherwise(UNKNOWN)
    )


def rate(part: Column | str, total: Column | str) -> Column:
    """part / total as double; null when the total is 0."""
    return F.try_divide(col_of(part).cast("double"), col_of(total).cast("double"))


def grid(c: Column | str, precision: int) -> Column:
    """Coordinate rounded to a grid: the scaled double is rounded, half away from zero."""
    scale = F.lit(10.0**precision)
    return F.round(col_of(c).cast("double") * scale) / scale


def jitter(c: Column | str, scale: float = 0.0005, seed: int = 42) -> Column:
    """Coordinate plus normal noise, for drawing overlapping points."""
    return col_of(c).cast("double") + F.randn(seed) * F.lit(scale)
