"""Cubes of partial aggregates: filtered questions are answered from the smallest one that covers them.

A cell holds the counts of all rows that agree on a question's dimensions and
on the columns that filters test. Cells keep those columns under their own
names, so `Filters` applies to cells exactly as it does to rows; counts add up,
shares are taken at the end. The finest grain is aggregated from the merged
table in one pass for all questions, each coarser one from the next finer one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.functions.numbers import to_int
from roadtally.functions.temporal import try_ts
from roadtally.operators.columns import has_role, quoted, resolve, role_col
from roadtally.operators.filters import Filters
from roadtally.plans.materialize import DIMENSIONS, LIVE, _facts, ordered, shape_answer
from roadtally.session import written
from roadtally.sources.readers import path_exists

#: Grains from fine to coarse: the columns that filters can test on their cells.
GRAINS = {
    "person": ("borough", "crash_datetime", "year", "person_injury", "person_type", "person_sex", "person_age", "vehicle_type"),
    "type": ("borough", "crash_datetime", "year", "person_injury", "person_type", "person_sex"),
    "place": ("borough", "crash_datetime", "year"),
    "all": (),
}
COUNTS = ("cnt", "injured", "fatalities")
#: Roles that dimensions are made of and no filter tests.
LABELLED = ("safety_equipment", "ejection", "position_in_vehicle")


def _filter_columns(merged: DataFrame) -> dict[str, Column]:
    """The columns that filters test, as coarse as filters can tell apart: the crash time by its year, the age as a number."""
    found = {c: role_col(merged, c) for c in GRAINS["person"] if has_role(merged, c)}
    if "crash_datetime" in found:
        found["crash_datetime"] = F.date_trunc("year", try_ts(found["crash_datetime"]))
    if "person_age" in found:
        found["person_age"] = to_int(found["person_age"])
    return found


def _facts_of(merged: DataFrame, tested: dict[str, Column]) -> DataFrame:
    """The questions' dimensions, the filters' columns and counts, as a table of its own.

    Rows that agree on all columns in use are counted first: that shuffle also
    spreads a table of a single file before any label is made.
    """
    used = {resolve(merged, r) for r in (*GRAINS["person"], *LABELLED)}
    counted = merged.groupBy(*[quoted(c) for c in merged.columns if c in used]).agg(F.count(F.lit(1)).alias("__cnt"))
    facts = _facts(counted.withColumns({f"__{c}": v for c, v in tested.items()}), *[F.col(f"__{c}") for c in tested], F.col("__cnt"))
    weighed = {c: (F.col(c) * F.col("__cnt")).alias(c) for c in ("is_injured", "is_fatal")}
    return written(facts.select(*[weighed.get(c, F.col(c)) for c in facts.columns]), "facts")


def _of_question(rows: DataFrame, question: str, tested: dict[str, str], sums: dict[str, str]) -> DataFrame:
    """Cells of a question from rows that hold its dimensions: only these and the tested columns are keys, the other dimensions are null."""
    names = list(dict.fromkeys(d for dims in DIMENSIONS.values() for d in dims))
    dims = DIMENSIONS[question]
    keys = [*[F.col(d).alias(d) for d in dims], *[F.col(c).alias(as_) for c, as_ in tested.items()]]
    cells = rows.groupBy(*keys).agg(*[F.sum(c).alias(as_) for c, as_ in sums.items()])
    none = {n: F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names if n not in dims}
    return cells.select(F.lit(question).alias("question"), *[none.get(n, F.col(n)) for n in names], *tested.values(), *COUNTS)


def finest(merged: DataFrame) -> DataFrame:
    """question, the questions' dimensions, the filters' columns, counts: the cells of the finest grain.

    The merged table is read once, for the facts; each question's aggregate
    reads its own columns of these.
    """
    tested = _filter_columns(merged)
    facts = _facts_of(merged, tested)
    sums = {"__cnt": "cnt", "is_injured": "injured", "is_fatal": "fatalities"}
    return reduce(DataFrame.unionByName, [_of_question(facts, q, {f"__{c}": c for c in tested}, sums) for q in DIMENSIONS])


def coarser(cells: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Cells added up over the filters' columns that are not kept."""
    kept = {c: c for c in cells.columns if c in keep}
    return reduce(DataFrame.unionByName, [_of_question(cells.where(F.col("question") == q), q, kept, dict(zip(COUNTS, COUNTS))) for q in DIMENSIONS])


def build_cubes(merged: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """All grains below `folder`, each partitioned by question, and `catalog`: grain, question, columns, rows."""
    spark = merged.sparkSession
    known = None
    cells = finest(merged)
    for grain, keep in GRAINS.items():
        cells = cells if grain == "person" else coarser(cells, keep)
        cells.write.mode(mode).partitionBy("question").parquet(f"{folder}/{grain}")
        cells = spark.read.schema(cells.schema).parquet(f"{folder}/{grain}")
        columns = [c for c in cells.columns if c in keep]
        sizes = cells.groupBy("question").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(grain).alias("grain"), "question", F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("columns"), "rows")
        known = sizes if known is None else known.unionByName(sizes)
    known.write.mode(mode).parquet(f"{folder}/catalog")


def tested_columns(filters: Filters) -> set[str] | None:
    """The columns that a filter looks at; None if cells cannot hold them (lists of vehicles and factors, sums of a row)."""
    if filters.factors or filters.min_injured:
        return None
    found = {
        "borough": filters.boroughs, "crash_datetime": filters.years, "year": filters.year_set, "person_type": filters.person_types,
        "person_injury": filters.injuries or filters.injured_only, "person_sex": filters.sexes, "vehicle_type": filters.vehicles,
        "person_age": filters.min_age is not None or filters.max_age is not None,
    }
    return {c for c, set_ in found.items() if set_} | {c.lower() for c in filters.facets}


def route(spark: SparkSession, name: str, folder: str, filters: Filters) -> str | None:
    """The grain with the fewest cells of the question that holds all tested columns; None if there is none."""
    tested = tested_columns(filters)
    if tested is None or not path_exists(spark, f"{folder}/catalog"):
        return None
    # a row for each grain and question
    fits = [r for r in spark.read.parquet(f"{folder}/catalog").where(F.col("question") == name).collect() if tested <= set(r["columns"])]
    return min(fits, key=lambda r: (r["rows"], r["grain"]))["grain"] if fits else None


def answer_from(spark: SparkSession, name: str, folder: str, grain: str, filters: Filters) -> DataFrame:
    """The question's rows from a grain's cells; only the question's partition is read."""
    cells = filters.apply(spark.read.parquet(f"{folder}/{grain}").where(F.col("question") == name))
    cells = cells.groupBy("question", *DIMENSIONS[name]).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return ordered(shape_answer(cells, name), name)


def answer(spark: SparkSession, name: str, merged: DataFrame, folder: str, filters: Filters = Filters()) -> DataFrame:
    """The question from the smallest cube that covers its filters, else from the merged table.

    Filters that test lists of vehicles or need the merged table's own vehicle
    lists are answered live, since there a row belongs to several labels.
    """
    listed = filters.vehicles and "vehicle_types_list" in merged.columns
    grain = None if listed else route(spark, name, folder, filters)
    return answer_from(spark, name, folder, grain, filters) if grain else LIVE[name](merged, filters)


def stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Cells and counted rows of each grain, to see what a route saves."""
    parts = [spark.read.parquet(f"{folder}/{g}").groupBy("question").agg(F.count(F.lit(1)).alias("cells"), F.sum("cnt").alias("cnt")).withColumn("grain", F.lit(g)) for g in GRAINS]
    return reduce(DataFrame.unionByName, parts).select("grain", "question", "cells", "cnt")
