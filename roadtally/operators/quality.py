"""Consistency checks and reconciliation of derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.operators.columns import quoted


def inconsistent(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Keys with more than one value (null is a value) in any column, and a flag per column.

    More than one value means min and max differ, or some rows are null and
    some are not; both aggregate per task before the shuffle.
    """
    n = F.count(F.lit(1))

    def varies(c: str) -> Column:
        v = F.col(quoted(c))
        mixed = (F.count(v) > 0) & (F.count(v) < n)
        return (F.coalesce(F.min(v) != F.max(v), F.lit(False)) | mixed).alias(c)

    flags = df.where(F.col(quoted(key)).isNotNull()).groupBy(quoted(key)).agg(*[varies(c) for c in cols])
    test = F.lit(False)
    for c in cols:
        test = test | F.col(quoted(c))
    return flags.where(test)


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) by one aggregate; a null condition is no violation."""
    row = df.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    cells = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def person_rules(c: dict[str, str] | None = None) -> dict[str, Column]:
    """The person table's consistency rules."""
    name = lambda role: F.col((c or {}).get(role, role))
    on_foot = ["ped_location", "ped_action", "ped_role"]
    is_ped = F.coalesce(name("person_type") == "Pedestrian", F.lit(False))
    some = name(on_foot[0]).isNotNull() | name(on_foot[1]).isNotNull() | name(on_foot[2]).isNotNull()
    age = name("person_age").try_cast("double")
    na = "Does Not Apply"
    return {
        "invalid_age": (age <= 0) | (age >= 120),
        "ejected_not_injured": (name("ejection") == "Ejected") & (name("person_injury") == "Unspecified"),
        "non_pedestrian_with_pedestrian_data": ~is_ped & some,
        "pedestrian_without_pedestrian_data": is_ped & ~some,
        "pedestrian_in_vehicle": is_ped & F.coalesce(name("position_in_vehicle") != na, F.lit(True)),
        "unspecified_without_detail": (name("person_injury") == "Unspecified")
        & (name("emotional_status") == na) & (name("bodily_injury") == na) & (name("complaint") == na),
    }


def reconcile(locations: DataFrame, summary: DataFrame, raw: DataFrame) -> DataFrame:
    """(measure, value): rows and totals of the derived tables against the source."""
    n = F.count(F.lit(1))
    frames = [
        (locations, {"location_rows": n}),
        (summary, {"summary_rows": n, "summary_count": F.sum("count"), "vehicle_types": F.count_distinct("vehicle_type")}),
        (raw, {"raw_rows": n}),
    ]
    out = None
    for frame, measures in frames:
        row = frame.agg(*[F.coalesce(m, F.lit(0)).cast("bigint").alias(name) for name, m in measures.items()])
        cells = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("value")) for k in measures])
        part = row.select(F.explode(cells).alias("c")).select("c.*")
        out = part if out is None else out.unionByName(part)
    return out
