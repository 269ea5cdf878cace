"""Raw crash records -> clean crash table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.functions.factors import MISSING, PLACEHOLDERS, UNSPECIFIED, normalize_factor
from roadtally.functions.streets import address_key, build_address, clean_street
from roadtally.functions.temporal import combine_datetime
from roadtally.functions.text import collect_labels, join_labels
from roadtally.functions.vehicles import classify_vehicle, vehicle_list
from roadtally.operators.columns import quoted
from roadtally.operators.filters import drop_uninformative, drop_zero_coords
from roadtally.operators.joins import lookup_fill
from roadtally.operators.spatial import Layer, as_layer, fill_place, locate
from roadtally.operators.windows import dedupe_first

FACTORS = [f"factor_{i}" for i in range(1, 6)]
KEPT_FACTORS = FACTORS[:3]
VEHICLES = [f"vehicle_{i}" for i in range(1, 6)]
STREETS = ["on_street_name", "cross_street_name", "off_street_name"]

# Portal column -> name used here.
PORTAL_NAMES = {
    "CRASH DATE": "crash_date",
    "CRASH TIME": "crash_time",
    "BOROUGH": "borough",
    "ZIP CODE": "zip_code",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "ON STREET NAME": "on_street_name",
    "CROSS STREET NAME": "cross_street_name",
    "OFF STREET NAME": "off_street_name",
    "NUMBER OF PERSONS INJURED": "persons_injured",
    "NUMBER OF PERSONS KILLED": "persons_killed",
    "NUMBER OF PEDESTRIANS INJURED": "pedestrians_injured",
    "NUMBER OF PEDESTRIANS KILLED": "pedestrians_killed",
    "NUMBER OF CYCLIST INJURED": "cyclist_injured",
    "NUMBER OF CYCLIST KILLED": "cyclist_killed",
    "NUMBER OF MOTORIST INJURED": "motorist_injured",
    "NUMBER OF MOTORIST KILLED": "motorist_killed",
    "COLLISION_ID": "collision_id",
}


def from_portal(raw: DataFrame) -> DataFrame:
    """Portal column names -> names used here; the location tuple is dropped."""
    names = dict(PORTAL_NAMES)
    names |= {f"CONTRIBUTING FACTOR VEHICLE {i}": f"factor_{i}" for i in range(1, 6)}
    names |= {f"VEHICLE TYPE CODE {i}": f"vehicle_{i}" for i in range(1, 6)}
    out = raw.withColumnsRenamed({old: new for old, new in names.items() if old in raw.columns})
    return out.drop("LOCATION").withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude") if c in out.columns})


def clean_factors(df: DataFrame, scheme: str = "main") -> DataFrame:
    """Normalise the factors, drop rows that name none, keep three and list the named ones."""
    out = df.withColumns({c: normalize_factor(c, scheme) for c in FACTORS if c in df.columns})
    out = drop_uninformative(out, KEPT_FACTORS)
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(MISSING)) for c in KEPT_FACTORS})
    out = out.withColumn("all_contributing_factors", collect_labels(KEPT_FACTORS, PLACEHOLDERS))
    out = out.withColumn("all_contributing_factors_str", join_labels(F.col("all_contributing_factors")))
    restored = {c: F.coalesce(F.nullif(F.col(c), F.lit(MISSING)), F.lit(UNSPECIFIED)) for c in KEPT_FACTORS}
    return out.withColumns(restored).drop(*FACTORS[3:])


def clean_vehicles(df: DataFrame, null_as_other: bool = False) -> DataFrame:
    """List of distinct classes, then each code replaced by its class."""
    codes = [c for c in VEHICLES if c in df.columns]
    out = df.withColumn("all_vehicle_types", vehicle_list(codes, null_as_other))
    return out.withColumns({c: classify_vehicle(c) for c in codes})


def clean_streets(df: DataFrame) -> DataFrame:
    out = df.withColumns({c: clean_street(c) for c in STREETS})
    return out.withColumn("full_address", build_address(*STREETS))


def clean_basics(df: DataFrame, null_as_other: bool = False) -> DataFrame:
    """Everything that needs no other table: factors, time, vehicles, streets."""
    out = clean_factors(df)
    out = out.withColumn("crash_datetime", combine_datetime("crash_date", "crash_time")).drop("crash_date", "crash_time")
    return clean_streets(clean_vehicles(out, null_as_other))


def fill_coordinates(df: DataFrame, geocodes: DataFrame, order: str, row_id: str | None = None, later_wins: bool = False) -> DataFrame:
    """Missing coordinates from a geocode table by row id, collision id, then address."""
    keys = []
    if row_id and "orig_index" in geocodes.columns:
        keys.append(("row", F.col(quoted(row_id)).cast("bigint"), F.col("orig_index").cast("bigint")))
    if "collision_id" in geocodes.columns:
        keys.append(("collision", F.col("collision_id").cast("string"), F.col("collision_id").cast("string")))
    if "full_address" in geocodes.columns:
        keys.append(("address", address_key("full_address"), address_key("full_address")))
    cols = {"latitude": "latitude_geocode", "longitude": "longitude_geocode"}
    return lookup_fill(df, geocodes, keys, cols, order, later_wins)


def fill_places(df: DataFrame, boroughs: DataFrame | Layer, zips: DataFrame | Layer) -> DataFrame:
    """Missing borough and ZIP from the polygon that contains the crash."""
    return fill_place(fill_place(df, boroughs, "borough"), zips, "zip_code")


def finish_places(df: DataFrame, boroughs: DataFrame | Layer, zips: DataFrame | Layer, max_m: float = 2000.0) -> DataFrame:
    """Located rows only; borough and ZIP by containing or nearest polygon; rows without either go."""
    located = drop_zero_coords(df.dropna(how="any", subset=["latitude", "longitude"]))
    out = located.drop("borough", "zip_code")
    out = locate(locate(out, boroughs, "borough", max_m), zips, "zip_code", max_m)
    return out.dropna(how="any", subset=["borough", "zip_code"])


def clean_crashes(
    raw: DataFrame,
    boroughs: DataFrame | Layer,
    zips: DataFrame | Layer,
    geocodes: DataFrame | None = None,
    geocode_order: str = "batch",
    order: list[str] | None = None,
) -> DataFrame:
    """The whole crash pipeline as one lazy plan (the polygon layers are indexed on the way).

    Borough and ZIP come from the final location alone, so they are not filled before it.
    """
    boroughs, zips = as_layer(boroughs), as_layer(zips)
    out = clean_basics(raw)
    if geocodes is not None:
        out = fill_coordinates(out, geocodes, geocode_order)
    out = dedupe_first(out, ["collision_id"], order or ["crash_datetime", "full_address"])
    return finish_places(out, boroughs, zips)


def unresolved(df: DataFrame) -> DataFrame:
    """Crashes that still lack coordinates."""
    return df.where(F.col("latitude").isNull() | F.col("longitude").isNull())
