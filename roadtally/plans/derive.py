"""Merged table -> locations, exploded summary, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.functions.temporal import try_ts
from roadtally.functions.text import UNKNOWN
from roadtally.operators.aggregates import labels_of
from roadtally.operators.columns import ensure_columns, has_role, quoted, resolve, role_col, with_totals
from roadtally.sources.facets import from_summary

SUMMARY_KEYS = ["borough", "year", "vehicle_type", "factor"]
TOTALS = ["n", "severity", "injured", "killed"]


def with_basics(merged: DataFrame, mode: str = "sum4") -> DataFrame:
    """Borough, year, totals and list columns under fixed names."""
    out = with_totals(merged, mode)
    out = ensure_columns(out, {"full_address": F.lit(None).cast("string")})
    ts = try_ts(role_col(out, "crash_datetime"))
    factors = "all_contributing_factors" if has_role(out, "all_contributing_factors") else "all_contributing_factors_str"
    return out.withColumns(
        {
            "borough": F.coalesce(role_col(out, "borough"), F.lit(UNKNOWN)),
            "year": F.year(ts),
            "crash_datetime": ts,
            "_vehicles": role_col(out, "all_vehicle_types"),
            "_factors": F.col(quoted(resolve(out, factors))),
        }
    )


def build_locations(merged: DataFrame, mode: str = "sum4") -> DataFrame:
    """Located rows with borough, year and severity."""
    out = with_basics(merged, mode)
    lat = role_col(out, "latitude").try_cast("double")
    lon = role_col(out, "longitude").try_cast("double")
    return out.select(
        lat.alias("latitude"), lon.alias("longitude"), "borough", "year", "severity_score",
        role_col(out, "full_address").alias("full_address"), "crash_datetime",
    ).where("latitude is not null and longitude is not null")


def summary_cells(merged: DataFrame, style: str = "known", mode: str = "sum4") -> DataFrame:
    """Summed totals per (borough, year, vehicle label, factor label).

    Rows with equal borough, year and list texts are added up first, so that
    parsing and the vehicle x factor explosion work on distinct texts.
    """
    base = with_basics(merged, mode)
    texts = base.groupBy("borough", "year", "_vehicles", "_factors").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("severity_score").alias("severity"),
        F.sum("total_injured").alias("injured"),
        F.sum("total_killed").alias("killed"),
    )
    return add_up(explode_cells(texts, style))


def explode_cells(texts: DataFrame, style: str, values: list[str] = TOTALS) -> DataFrame:
    """One row per (vehicle, factor) pair of each row's own lists, with the columns `values`."""
    pairs = texts.select(
        "borough", "year", F.explode(labels_of(texts, "_vehicles", style)).alias("vehicle_type"),
        labels_of(texts, "_factors", style).alias("_labels"), *values,
    )
    return pairs.select("borough", "year", "vehicle_type", F.explode("_labels").alias("factor"), *values)


def add_up(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*SUMMARY_KEYS).agg(*[F.sum(t).alias(t) for t in TOTALS])


def as_summary(cells: DataFrame) -> DataFrame:
    """Summed totals -> count, mean severity and sums."""
    mean: Column = F.col("severity").cast("double") / F.col("n")
    return cells.select(
        *SUMMARY_KEYS, F.col("n").alias("count"), mean.alias("avg_severity"),
        F.col("injured").alias("sum_injured"), F.col("killed").alias("sum_killed"),
    )


def build_summary(merged: DataFrame, style: str = "known", mode: str = "sum4") -> DataFrame:
    """Exploded summary. A crash counts once per (vehicle, factor) pair it names."""
    return as_summary(summary_cells(merged, style, mode))


def build_facets(merged: DataFrame, style: str = "known") -> DataFrame:
    """(facet, value) rows: the distinct boroughs, years, vehicle types and factors."""
    return from_summary(build_summary(merged, style))
