"""Column-name resolution, defaults and schema helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.functions.numbers import KILLED_WEIGHT, PARTIES, to_int0
from roadtally.functions.text import UNKNOWN, normalize_borough, or_unknown, parse_list
from roadtally.functions.streets import fallback_address
from roadtally.functions.temporal import date_parts, try_ts

# Other names under which a column role may appear.
SYNONYMS = {
    "total_injured": ("sum_injured", "injured_total"),
    "total_killed": ("sum_killed", "killed_total"),
    "all_contributing_factors": ("contributing_factors", "factors", "factor"),
    "person_sex": ("sex", "gender"),
    "person_age": ("age",),
    "day_of_week": ("dayofweek", "dow"),
    "hour": ("crash_hour", "h"),
    "latitude": ("lat",),
    "longitude": ("lon", "lng"),
    "severity_score": ("severity",),
    "safety_equipment": ("safety", "safety_device"),
    "person_injury": ("injury", "injury_severity", "injury_level"),
    "person_type": ("personrole", "type"),
    "crash_time": ("time",),
    "crash_date": ("date",),
    "ejection": ("ejected",),
    "position_in_vehicle": ("position",),
    "number_of_persons_killed": ("num_killed", "persons_killed"),
    "vehicle_type": ("veh_type",),
}


def _bare(name: str) -> str:
    return re.sub(r"[^0-9a-z]", "", name.lower())


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def resolve(df: DataFrame, role: str) -> str:
    """Actual column for a role.

    Rules in order: same name ignoring case, same letters and digits, a
    synonym by either rule, the first column that contains the role's letters,
    and at last the role's own name.
    """
    exact = {c.lower(): c for c in df.columns}
    bare = {_bare(c): c for c in df.columns}
    for name in (role, *SYNONYMS.get(role.lower(), ())):
        hit = exact.get(name.lower()) or bare.get(_bare(name))
        if hit:
            return hit
    wanted = _bare(role)
    return next((c for b, c in bare.items() if wanted and wanted in b), role)


def has_role(df: DataFrame, role: str) -> bool:
    return resolve(df, role) in df.columns


def role_col(df: DataFrame, role: str):
    return F.col(quoted(resolve(df, role)))


def rename_roles(df: DataFrame, roles: list[str]) -> DataFrame:
    """Rename the columns found for `roles` to the role names; the rest stays."""
    found = {resolve(df, r): r for r in roles if has_role(df, r)}
    return df.withColumnsRenamed({old: new for old, new in found.items() if old != new})


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add the missing columns with a constant or a Column as value."""
    have = {c.lower() for c in df.columns}
    missing = {
        name: (value if hasattr(value, "alias") else F.lit(value))
        for name, value in defaults.items()
        if name.lower() not in have
    }
    return df.withColumns(missing) if missing else df


def count_column(df: DataFrame, party: str, outcome: str) -> str | None:
    """Name of e.g. the 'persons injured' count, in any spelling, if it is there."""
    bare = {_bare(c): c for c in df.columns}
    return bare.get(f"numberof{party}{outcome}") or bare.get(f"{party}{outcome}")


def with_totals(df: DataFrame, mode: str = "sum4", keep_severity: bool = False) -> DataFrame:
    """Add `total_injured`, `total_killed` and `severity_score`.

    `sum4` adds persons, pedestrians, cyclists and motorists, although
    'persons' includes the other three; `persons` takes that count alone. A
    missing count is 0. With `keep_severity` an existing score stays.
    """
    parties = {"sum4": PARTIES, "persons": PARTIES[:1]}[mode]

    def total(outcome: str):
        names = [n for p in parties if (n := count_column(df, p, outcome))]
        parts = [to_int0(quoted(n)) for n in names] or [F.lit(0).cast("bigint")]
        return sum(parts[1:], parts[0])

    out = df.withColumns({"total_injured": total("injured"), "total_killed": total("killed")})
    if keep_severity and has_role(df, "severity_score"):
        return out
    return out.withColumn("severity_score", F.col("total_injured") + F.lit(KILLED_WEIGHT) * F.col("total_killed"))


def with_date_parts(df: DataFrame, ts: str = "crash_datetime") -> DataFrame:
    return df.withColumns(date_parts(ts))


def with_row_id(df: DataFrame, name: str = "unique_id", order: list[str] | None = None) -> DataFrame:
    """Unique row ids.

    Without an order the ids are unique but not dense. With one they are dense,
    from 1 in that order: the rows are range-partitioned, each partition is
    numbered on its own and the offsets come from a small count per partition.
    """
    if not order:
        return df.withColumn(name, F.monotonically_increasing_id())
    from roadtally.operators.windows import dense_row_number

    return dense_row_number(df, order, name)


def prepare_dashboard(df: DataFrame) -> DataFrame:
    """Working columns of a merged table: borough casing, date parts, numbers, lists, defaults."""
    roles = [
        "borough", "crash_datetime", "latitude", "longitude", "all_vehicle_types", "all_contributing_factors",
        "person_type", "person_age", "person_sex", "person_injury", "ejection", "safety_equipment",
        "on_street_name", "full_address", "zip_code",
    ]
    out = rename_roles(df, [r for r in roles if _bare(r) in {_bare(c) for c in df.columns}])
    text_defaults = {
        name: UNKNOWN
        for name in (
            "person_type", "position_in_vehicle_clean", "person_sex", "bodily_injury", "safety_equipment",
            "emotional_status", "ejection", "zip_code", "person_injury", "complaint",
        )
    }
    out = ensure_columns(
        out,
        {
            "borough": UNKNOWN,
            "crash_datetime": F.lit(None).cast("timestamp_ntz"),
            "latitude": F.lit(None).cast("double"),
            "longitude": F.lit(None).cast("double"),
            "all_vehicle_types": F.lit(None).cast("string"),
            "all_contributing_factors": F.lit(None).cast("string"),
            "on_street_name": F.lit(None).cast("string"),
            "person_age": 0,
            **text_defaults,
        },
    )
    out = out.withColumn("borough", normalize_borough("borough"))
    out = ensure_columns(out, {"full_address": fallback_address("on_street_name", "borough")})
    out = out.withColumns(
        {
            "crash_datetime": try_ts("crash_datetime"),
            "latitude": F.col("latitude").try_cast("double"),
            "longitude": F.col("longitude").try_cast("double"),
            "vehicle_types_list": parse_list("all_vehicle_types"),
            "factors_list": parse_list("all_contributing_factors"),
        }
    )
    return with_date_parts(with_totals(out))


def label_lists(df: DataFrame, vehicles: str, factors: str) -> DataFrame:
    return df.withColumns({"vehicles": or_unknown(parse_list(vehicles)), "factors": or_unknown(parse_list(factors))})


def split_columns(df: DataFrame, crash_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Crash-level and person-level columns as two frames."""
    crash = [c for c in df.columns if c in crash_cols]
    person = [c for c in df.columns if c not in crash_cols]
    return df.select(*[quoted(c) for c in crash]), df.select(*[quoted(c) for c in person])


def null_rates(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Share of nulls per column, by one aggregate."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return {c: (1 - row[f"c{i}"] / row["n"]) if row["n"] else 0.0 for i, c in enumerate(cols)}


def drop_sparse(df: DataFrame, max_null: float = 0.8, cols: list[str] | None = None) -> DataFrame:
    """Drop the columns of which more than `max_null` is null."""
    return df.drop(*[c for c, r in null_rates(df, cols).items() if r > max_null])


def schema_diff(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Columns in both frames, and in one only."""
    a, b = set(left.columns), set(right.columns)
    return {"common": sorted(a & b), "only_left": sorted(a - b), "only_right": sorted(b - a)}
