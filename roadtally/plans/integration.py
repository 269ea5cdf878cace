"""Persons and crashes -> one merged table at person grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.operators.joins import integrate
from roadtally.operators.windows import fill_within
from roadtally.plans.persons import clean_position

CRITICAL = [
    "borough", "zip_code", "latitude", "longitude", "on_street_name", "off_street_name", "cross_street_name",
]


def fill_streets(df: DataFrame) -> DataFrame:
    streets = [c for c in CRITICAL if c.endswith("street_name") and c in df.columns]
    return df.na.fill("Unknown Street", streets)


def merge(persons: DataFrame, crashes: DataFrame, order: list[str] | None = None, hot: dict | None = None) -> DataFrame:
    """Left join, seat labels, rows without any place dropped, gaps filled within a collision, then unknown streets named.

    `hot` are the persons' hot collisions, if the caller knows them; else they
    are looked up in the persons table, once.
    """
    merged = integrate(persons, crashes, hot=hot)
    if "position_in_vehicle" in merged.columns:
        merged = merged.withColumn("position_in_vehicle_clean", clean_position("position_in_vehicle")).drop("position_in_vehicle")
    there = [c for c in CRITICAL if c in merged.columns]
    placed = merged.where(F.coalesce(*[F.col(c).cast("string") for c in there]).isNotNull())
    return fill_streets(fill_within(placed, "collision_id", there, order or ["unique_id"]))
