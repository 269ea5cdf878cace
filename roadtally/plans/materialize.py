"""Materialised answers: all person-level aggregates from one pass over the merged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.functions.numbers import age_band, rate
from roadtally.functions.temporal import day_type, try_ts
from roadtally.functions.text import is_fatal, is_injured, label, label_equipment
from roadtally.functions.vehicles import vehicle_class
from roadtally.operators import questions as q
from roadtally.operators.columns import has_role, role_col
from roadtally.operators.filters import Filters
from roadtally.sources.readers import path_exists

# question -> its dimensions among the columns of `_facts`.
DIMENSIONS = {
    "safety_vs_injury": ("safety", "injury_or_blank"),
    "injuries_by_hour": ("dated", "hour", "injury_or_blank"),
    "age_group_counts": ("age_group",),
    "severity_by_gender": ("sex", "injury"),
    "person_type_injury_rates": ("person_type_label",),
    "ejection_vs_severity": ("ejection_label", "injury"),
    "position_vs_severity": ("position", "injury"),
    "weekday_weekend_injuries": ("dated", "day_type"),
    "motorcycle_vs_car_fatalities": ("vtype",),
    "borough_vs_injury": ("borough_label", "injury"),
}
# Order of each question's rows: columns, falling ones with a minus.
ORDER = {
    "safety_vs_injury": ("-cnt", "safety", "injury"),
    "injuries_by_hour": ("hour", "injury"),
    "age_group_counts": ("-cnt", "age_group"),
    "severity_by_gender": ("-cnt", "sex", "injury"),
    "person_type_injury_rates": ("-injured", "person_type_label"),
    "ejection_vs_severity": ("-cnt", "ejection_label", "injury"),
    "position_vs_severity": ("-cnt", "position", "injury"),
    "weekday_weekend_injuries": ("day_type",),
    "motorcycle_vs_car_fatalities": ("vtype",),
    "borough_vs_injury": ("borough_label", "injury"),
}
LIVE = {name: getattr(q, name) for name in DIMENSIONS}


def _facts(merged: DataFrame, *more: Column) -> DataFrame:
    """The label columns that the questions group by, and the two tests they count; `more` columns are kept."""

    def col(role: str):
        return role_col(merged, role) if has_role(merged, role) else F.lit(None).cast("string")

    ts, injury = col("crash_datetime"), col("person_injury")
    return merged.select(
        label_equipment(col("safety_equipment")).alias("safety"),
        label(injury, "").alias("injury_or_blank"),
        label(injury).alias("injury"),
        ts.isNotNull().alias("dated"),
        F.hour(try_ts(ts)).alias("hour"),
        day_type(ts).alias("day_type"),
        age_band(col("person_age")).alias("age_group"),
        label(col("person_sex")).alias("sex"),
        label(col("person_type")).alias("person_type_label"),
        label(col("ejection")).alias("ejection_label"),
        label(col("position_in_vehicle")).alias("position"),
        vehicle_class(col("vehicle_type")).alias("vtype"),
        label(col("borough")).alias("borough_label"),
        is_injured(injury).cast("int").alias("is_injured"),
        is_fatal(injury).cast("int").alias("is_fatal"),
        *more,
    )


def answer_cells(merged: DataFrame) -> DataFrame:
    """One row per question and combination of its dimensions, by grouping sets.

    The table is read once for all questions, and each task sends only its
    partial counts into the shuffle.
    """
    names = list(dict.fromkeys(d for dims in DIMENSIONS.values() for d in dims))
    sets = list(DIMENSIONS.values())

    def set_id(dims: tuple[str, ...]) -> int:
        return sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in dims)

    question = F.create_map(*[F.lit(x) for name, dims in DIMENSIONS.items() for x in (set_id(dims), name)])
    cells = _facts(merged).groupingSets([[F.col(d) for d in dims] for dims in sets], *names).agg(
        F.grouping_id().cast("int").alias("_set"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("is_injured").alias("injured"),
        F.sum("is_fatal").alias("fatalities"),
    )
    return cells.withColumn("question", F.try_element_at(question, F.col("_set"))).drop("_set")


def shape_answer(cells: DataFrame, name: str) -> DataFrame:
    """One question's rows of the cells, in the form of the live question."""
    mine = cells.where(F.col("question") == name)
    if "dated" in DIMENSIONS[name]:
        mine = mine.where("dated")
    dims = [F.col(d).alias("injury") if d == "injury_or_blank" else F.col(d) for d in DIMENSIONS[name] if d != "dated"]
    if name == "person_type_injury_rates":
        return mine.select(*dims, "injured", F.col("cnt").alias("total")).withColumn("rate", rate("injured", "total"))
    if name == "weekday_weekend_injuries":
        return mine.select(*dims, "injured")
    if name == "motorcycle_vs_car_fatalities":
        return mine.select(*dims, "fatalities", F.col("cnt").alias("total")).withColumn("fatality_rate", rate("fatalities", "total"))
    return mine.select(*dims, "cnt")


def ordered(rows: DataFrame, name: str) -> DataFrame:
    """A question's rows in its order, cut where the live question cuts them."""
    by = [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in ORDER[name]]
    rows = rows.orderBy(*by)
    return rows.limit(1000) if name == "safety_vs_injury" else rows


def materialize(merged: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Write one table per question below `folder`.

    The cells are written first, so the ten tables come from a small table and
    not from ten passes over the merged one.
    """
    spark = merged.sparkSession
    answer_cells(merged).write.mode(mode).parquet(f"{folder}/_cells")
    cells = spark.read.parquet(f"{folder}/_cells")
    for name in DIMENSIONS:
        shape_answer(cells, name).write.mode(mode).parquet(f"{folder}/{name}")


def answer(spark: SparkSession, name: str, merged: DataFrame, folder: str, filters: Filters = Filters()) -> DataFrame:
    """The materialised table if it exists and nothing is filtered, else the live question."""
    if filters.empty and path_exists(spark, f"{folder}/{name}"):
        return ordered(spark.read.parquet(f"{folder}/{name}"), name)
    return LIVE[name](merged, filters)
