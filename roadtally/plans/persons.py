"""Raw person records -> clean person table.

The rules are applied in a fixed order, as later rules read what earlier ones
wrote. A null is unequal to every value, so `is_not` holds for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.functions.ids import is_single_digit, legacy_uuid
from roadtally.functions.temporal import combine_datetime
from roadtally.functions.text import clean_text, lookup_label
from roadtally.operators.filters import not_future
from roadtally.operators.stats import fill_mode_by_group, impute_mean
from roadtally.session import written

# Person types, statuses and seat positions as the records spell them.
OCCUPANT, PEDESTRIAN, BICYCLIST, OTHER_MOTORIZED = "Occupant", "Pedestrian", "Bicyclist", "Other Motorized"
NA, UNKNOWN, DRIVER = "Does Not Apply", "Unknown", "Driver"
OUTSIDE = "Riding/Hanging on Outside"
FRONT_PASSENGER = "Front passenger, if two or more persons, including the driver, are in the front seat"
MIDDLE_FRONT = "Middle front seat, or passenger lying across a seat"
MIDDLE_REAR = "Middle rear seat, or passenger lying across a seat"
LEFT_REAR = "Left rear passenger, or rear passenger on a bicycle, motorcycle, snowmobile"
RIGHT_REAR = "Right rear passenger or motorcycle sidecar passenger"
LAP = "If one person is seated on another person&apos;s lap"
OTHER_REAR = "Any person in the rear of a station wagon, pick-up truck, all passengers on a bus, etc"
PED_COLUMNS = ["ped_location", "ped_action", "ped_role"]
DETAIL_COLUMNS = ["ejection", "emotional_status", "bodily_injury", "complaint", "position_in_vehicle", "safety_equipment"]
TEXT_COLUMNS = [
    "person_type", "person_injury", "person_sex", "ped_role", "ejection", "emotional_status", "bodily_injury",
    "position_in_vehicle", "safety_equipment", "ped_location", "ped_action", "complaint",
    "contributing_factor_1", "contributing_factor_2",
]
POSITION_LABELS = {
    DRIVER: "DRIVER",
    FRONT_PASSENGER: "FRONT PASSENGER",
    MIDDLE_FRONT: "MIDDLE FRONT",
    LEFT_REAR: "REAR LEFT",
    MIDDLE_REAR: "REAR MIDDLE",
    RIGHT_REAR: "REAR RIGHT",
    OUTSIDE: "OUTSIDE VEHICLE",
    LAP: "LAP SEATED",
    OTHER_REAR: "OTHER REAR",
    NA: "NOT APPLICABLE",
    UNKNOWN: "UNKNOWN",
}
# Seat positions that do not fit a person type.
UNLIKELY_INFANT = (OUTSIDE, DRIVER, RIGHT_REAR)
UNLIKELY_BICYCLIST = (
    OTHER_REAR, FRONT_PASSENGER, LAP, "middle front seat, or passenger lying across a seat", MIDDLE_REAR, MIDDLE_FRONT, RIGHT_REAR,
)
UNLIKELY_OCCUPANT = (OUTSIDE, NA)
UNLIKELY_MOTORIZED = (FRONT_PASSENGER, MIDDLE_FRONT, MIDDLE_REAR, OTHER_REAR)
UNLIKELY_SKATER_EQUIPMENT = ("Lap Belt & Harness", "Lap Belt")


def is_(c: str, *values: str) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


def is_not(c: str, value: str) -> Column:
    return ~is_(c, value)


def put(df: DataFrame, c: str, test: Column, value: str) -> DataFrame:
    """Set the column where the test holds."""
    return df.withColumn(c, F.when(test, F.lit(value)).otherwise(F.col(c)))


def younger(age: int) -> Column:
    return F.coalesce(F.col("person_age").try_cast("double") < age, F.lit(False))


def fix_ids(df: DataFrame) -> DataFrame:
    """Seven-digit ids as UUIDs; rows with one-digit ids or without a vehicle go."""
    out = df.withColumn("person_id", legacy_uuid("person_id")).where(~is_single_digit("person_id"))
    return out.dropna(subset=["vehicle_id"])


def fix_young_positions(df: DataFrame) -> DataFrame:
    """Seats that a small child cannot have become unknown (which no later age rule changes)."""
    misplaced = (
        (is_("person_type", OCCUPANT) & younger(3) & is_("position_in_vehicle", *UNLIKELY_INFANT))
        | (is_("person_type", OCCUPANT) & younger(12) & is_("position_in_vehicle", DRIVER))
        | (is_("person_type", BICYCLIST) & younger(3) & is_("position_in_vehicle", DRIVER))
    )
    return put(df, "position_in_vehicle", misplaced, UNKNOWN)


def fix_pedestrian(df: DataFrame, drop_details: bool = True) -> DataFrame:
    """Pedestrian-only columns read 'Does Not Apply' for others; pedestrians lacking all three go."""
    walks = is_("person_type", PEDESTRIAN)
    out = df.withColumns({c: F.when(walks, F.col(c)).otherwise(F.lit(NA)) for c in PED_COLUMNS})
    out = out.dropna(how="all", subset=PED_COLUMNS)
    return out.drop("ped_action", "ped_location") if drop_details else out


def fix_type_positions(df: DataFrame) -> DataFrame:
    """Seats that do not fit the person type; a row has one type, so one rule at most applies."""
    seat = F.col("position_in_vehicle")
    fixed = (
        F.when(is_("person_type", PEDESTRIAN), NA)
        .when(is_("person_type", BICYCLIST) & seat.isin(*UNLIKELY_BICYCLIST), NA)
        .when(is_("person_type", OCCUPANT) & seat.isin(*UNLIKELY_OCCUPANT), UNKNOWN)
        .when(is_("person_type", OTHER_MOTORIZED) & seat.isin(*UNLIKELY_MOTORIZED), UNKNOWN)
        .otherwise(seat)
    )
    return df.withColumn("position_in_vehicle", fixed)


def fix_positions(df: DataFrame) -> DataFrame:
    """All seven seat rules in order."""
    return fix_type_positions(fix_young_positions(df))


def fix_ejection(df: DataFrame) -> DataFrame:
    """Ejection by person type, then injury and emotional status that follow from it."""
    ejection = F.col("ejection")
    by_type = (
        F.when(is_("person_type", BICYCLIST, OTHER_MOTORIZED, PEDESTRIAN), NA)
        .when(is_("person_type", OCCUPANT) & (ejection == NA), UNKNOWN)
        .otherwise(ejection)
    )
    out = df.withColumn("ejection", by_type)
    out = put(out, "person_injury", is_("ejection", "Ejected") & is_not("person_injury", "Killed"), "Injured")
    out = put(out, "emotional_status", is_("person_injury", "Killed"), "Apparent Death")
    fatal = is_("ejection", "Ejected") & is_("bodily_injury", "Head") & is_("emotional_status", "Unconscious")
    return put(out, "person_injury", fatal, "Killed")


def fix_equipment(df: DataFrame) -> DataFrame:
    """Equipment that does not fit the role. The last rule is kept although nothing matches it."""
    skater = is_("ped_role", "In-Line Skater")
    unfit = is_("ped_role", PEDESTRIAN) | (skater & is_("safety_equipment", *UNLIKELY_SKATER_EQUIPMENT))
    out = put(df, "safety_equipment", unfit, UNKNOWN)
    return put(out, "position_in_vehicle", skater & is_("safety_equipment", "In-Line Skater"), DRIVER)


def fill_complaint(df: DataFrame) -> DataFrame:
    """Missing complaints take the most frequent one of the same bodily injury."""
    return fill_mode_by_group(df, "bodily_injury", "complaint", (NA, UNKNOWN), UNKNOWN)


def standardize(df: DataFrame, cols: list[str] = TEXT_COLUMNS) -> DataFrame:
    """Lower-cased, stripped text; null and 'nan' read 'unknown'."""
    there = [c for c in cols if c in df.columns]
    low = {c: F.coalesce(F.nullif(clean_text(F.col(c)), F.lit("nan")), F.lit("unknown")) for c in there}
    return df.withColumns(low)


def clean_position(c: Column | str) -> Column:
    """Short seat label; unknown spellings read 'OTHER'. Case does not matter."""
    return lookup_label(c, {k.lower(): v for k, v in POSITION_LABELS.items()}, "OTHER")


def with_datetime(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Date and time joined; rows dated in the future, or undated, go."""
    stamped = df.withColumns(
        {
            "_day": combine_datetime("crash_date", F.lit("0:00")),
            "crash_datetime": combine_datetime("crash_date", "crash_time"),
        }
    )
    return not_future(stamped, "_day", as_of).drop("_day", "crash_date", "crash_time")


def clean_persons(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """The whole person pipeline.

    The rows with their imputed ages are a table of their own: the mean is
    taken once, and the modes of the complaints do not run the reading again.
    """
    out = fix_ids(with_datetime(raw, as_of))
    out = impute_mean(out, "person_age", 0, 120)
    out = out.drop("contributing_factor_1", "contributing_factor_2")
    out = written(out.withColumn("person_sex", F.coalesce("person_sex", F.lit("U"))), "persons")
    out = fix_type_positions(fix_pedestrian(fix_young_positions(out)))
    out = out.dropna(how="all", subset=DETAIL_COLUMNS)
    out = fix_equipment(fix_ejection(fill_complaint(out)))
    return standardize(out).dropDuplicates()
