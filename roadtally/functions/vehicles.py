"""Vehicle classes from free-text vehicle codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import col_of

OTHER = "Other"

# Class -> pattern, tried from top to bottom, first hit wins.
VEHICLE_PATTERNS = {
    "Sedan": r"\b(sedan|4 dr|2 dr)\b",
    "SUV/Station Wagon": r"\b(suv|station wagon|sport utility|suv/sta)\b",
    "Pickup Truck": r"\b(pick[- ]?up|pickup|pick up truck)\b",
    "Truck/Commercial": r"\b(truck|tractor truck|flatbed|semi|delivery|box truck|commercial|bulk|garbage|tow[- ]?truck|dump|concrete|milk|beverage)\b",
    "Van": r"\b(van|van camper|refrigerated|utility van|work van|uhaul)\b",
    "Motorcycle": r"\b(motorcycle|motorbike|moped|moped/scooter|scooter|e-bike|ebike|motorscooter|dirt bike)\b",
    "Bus": r"\b(bus|school bus|mta|nyc transit|omnibus|coach)\b",
    "Taxi": r"\b(taxi|livery)\b",
    "Ambulance": r"\b(ambulance|fdny|nyc ambula)\b",
    "Pedicab": r"\b(pedicab)\b",
    "Bicycle": r"\b(bike|bicycle|unicycle)\b",
}

# Keywords of the two-way motorcycle / car comparison.
MOTORCYCLE_WORDS = "motor|bike"
CAR_WORDS = "sedan|car|pass|auto"


def classify_vehicle(c: Column | str) -> Column:
    """One of twelve classes; null and unmatched text are 'Other'."""
    text = F.lower(col_of(c))
    first, *rest = VEHICLE_PATTERNS.items()
    chain = reduce(
        lambda acc, kv: acc.when(text.rlike("(?U)" + kv[1]), kv[0]),
        rest,
        F.when(text.rlike("(?U)" + first[1]), first[0]),
    )
    return chain.otherwise(OTHER)


def vehicle_class(c: Column | str) -> Column:
    """'Motorcycle', 'Car' or 'Other' by keyword."""
    text = F.lower(col_of(c))
    return F.when(text.rlike(MOTORCYCLE_WORDS), "Motorcycle").when(text.rlike(CAR_WORDS), "Car").otherwise(OTHER)


def vehicle_list(codes: list[str], null_as_other: bool = False) -> Column:
    """Distinct classes of the code columns, in column order.

    By default null codes are left out. With `null_as_other` a null code counts
    as 'Other' and 'Other' moves to the end of the list.
    """
    classes = F.array_distinct(F.array(*[F.when(F.col(c).isNotNull(), classify_vehicle(c)) for c in codes]))
    if not null_as_other:
        return F.filter(classes, lambda v: v.isNotNull())
    has_other = F.exists(classes, lambda v: v.isNull() | (v == OTHER))
    named = F.filter(classes, lambda v: v.isNotNull() & (v != OTHER))
    return F.concat(named, F.when(F.coalesce(has_other, F.lit(True)), F.array(F.lit(OTHER))).otherwise(F.array().cast("array<string>")))
