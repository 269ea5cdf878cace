"""The dashboard questions: each takes a table and filters and returns a small result frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadtally.functions.numbers import age_band, grid, rate
from roadtally.functions.temporal import WEEKDAYS, day_number, day_type, trunc_to, try_ts
from roadtally.functions.text import is_fatal, is_injured, label, label_equipment
from roadtally.functions.vehicles import vehicle_class
from roadtally.operators.aggregates import count_labels, top_labels
from roadtally.operators.columns import has_role, quoted, resolve, role_col
from roadtally.operators.filters import Filters, sample
from roadtally.operators.stats import box_stats, histogram

NO_FILTERS = Filters()


def _n() -> Column:
    return F.count(F.lit(1))


def injuries_by_borough(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    injured = F.sum(F.coalesce(role_col(d, "total_injured"), F.lit(0))).alias("total_injured")
    return d.groupBy(role_col(d, "borough").alias("borough")).agg(injured).orderBy(F.desc("total_injured"), "borough")


def factor_bar(df: DataFrame, filters: Filters = NO_FILTERS, top_n: int = 15, weighted: bool = True, style: str = "list") -> DataFrame:
    """Most frequent factors.

    On a summary (a table with a `factor` column) the rows weigh by their
    count; `weighted=False` counts summary rows instead.
    """
    d = filters.apply(df)
    single = next((c for c in d.columns if c.lower() == "factor"), None)
    if single is None:
        return top_labels(d, resolve(d, "all_contributing_factors"), top_n, style, "factor")
    weight = next((c for c in d.columns if c.lower() in ("count", "cnt")), None)
    cnt = F.sum(quoted(weight)) if weighted and weight else _n()
    rows = d.where(F.col(quoted(single)).isNotNull()).groupBy(F.col(quoted(single)).alias("factor"))
    return rows.agg(cnt.alias("cnt")).orderBy(F.desc("cnt"), "factor").limit(top_n)


def crashes_by_year(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    year = F.year(try_ts(role_col(d, "crash_datetime"))).alias("year")
    return d.groupBy(year, role_col(d, "borough").alias("borough")).agg(_n().alias("crashes")).orderBy("year", "borough")


def map_aggregate_scatter(df: DataFrame, filters: Filters = NO_FILTERS, limit: int = 20000, precision: int = 3) -> DataFrame:
    """Densest grid cells with mean severity and marker size."""
    d = filters.apply(df)
    lat, lon = role_col(d, "latitude"), role_col(d, "longitude")
    cells = (
        d.where(lat.isNotNull() & lon.isNotNull())
        .groupBy(grid(lat, precision).alias("lat"), grid(lon, precision).alias("lon"))
        .agg(_n().alias("cnt"), F.avg(F.coalesce(role_col(d, "severity_score"), F.lit(0))).alias("severity_mean"))
        .orderBy(F.desc("cnt"), "lat", "lon")
        .limit(limit)
    )
    # The frame holds at most `limit` rows here.
    whole = Window.partitionBy()
    least, most = F.min("cnt").over(whole), F.max("cnt").over(whole)
    return cells.withColumn("size", (F.col("cnt") - least + 1) / (most - least + 1) * 30 + 5)


def gender_pie(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    return d.groupBy(role_col(d, "person_sex").alias("sex")).agg(_n().alias("cnt")).orderBy(F.desc("cnt"), "sex")


def age_histogram(df: DataFrame, filters: Filters = NO_FILTERS, nbins: int = 30) -> DataFrame:
    d = filters.apply(df)
    return histogram(d, resolve(d, "person_age"), nbins)


def age_box(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    return box_stats(d, resolve(d, "person_age"))


def temporal_heatmap(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Rows per weekday and hour, Monday first."""
    d = filters.apply(df)
    ts = role_col(d, "crash_datetime")
    cells = d.where(ts.isNotNull()).groupBy(day_number(ts).alias("_day"), F.hour(try_ts(ts)).alias("hour")).agg(_n().alias("cnt"))
    name = F.try_element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), F.col("_day") + 1)
    return cells.orderBy("_day", "hour").select(name.alias("day_of_week"), "hour", "cnt")


def severity_by_borough(df: DataFrame, filters: Filters = NO_FILTERS, skip_null: bool = False) -> DataFrame:
    d = filters.apply(df)
    score = role_col(d, "severity_score")
    mean = F.avg(score if skip_null else F.coalesce(score, F.lit(0))).alias("avg_severity")
    return d.groupBy(role_col(d, "borough").alias("borough")).agg(mean).orderBy(F.desc("avg_severity"), "borough")


def density_points(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """One (lat, lon, severity) row per located crash."""
    d = filters.apply(df)
    lat, lon = role_col(d, "latitude"), role_col(d, "longitude")
    return d.where(lat.isNotNull() & lon.isNotNull()).select(
        lat.alias("latitude"), lon.alias("longitude"), F.coalesce(role_col(d, "severity_score"), F.lit(0)).alias("severity")
    )


def density_grid(df: DataFrame, filters: Filters = NO_FILTERS, precision: int = 3) -> DataFrame:
    """Severity summed per grid cell: the density map's input for large tables."""
    points = density_points(df, filters)
    return points.groupBy(grid("latitude", precision).alias("lat"), grid("longitude", precision).alias("lon")).agg(
        F.sum("severity").alias("severity"), _n().alias("cnt")
    )


def _by_injury(d: DataFrame, dim: Column, name: str, null_if: str = "Unknown") -> DataFrame:
    injury = label(role_col(d, "person_injury"), null_if).alias("injury")
    return d.groupBy(dim.alias(name), injury).agg(_n().alias("cnt"))


def safety_vs_injury(df: DataFrame, filters: Filters = NO_FILTERS, sample_frac: float | None = None, limit: int | None = 1000) -> DataFrame:
    d = sample(filters.apply(df), sample_frac)
    out = _by_injury(d, label_equipment(role_col(d, "safety_equipment")), "safety", "").orderBy(F.desc("cnt"), "safety", "injury")
    return out.limit(limit) if limit else out


def injuries_by_hour(df: DataFrame, filters: Filters = NO_FILTERS, sample_frac: float | None = None) -> DataFrame:
    d = sample(filters.apply(df), sample_frac)
    ts = role_col(d, "crash_datetime")
    d = d.where(ts.isNotNull())
    return _by_injury(d, F.hour(try_ts(ts)), "hour", "").orderBy("hour", "injury")


def age_group_counts(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    return d.groupBy(age_band(role_col(d, "person_age")).alias("age_group")).agg(_n().alias("cnt")).orderBy(F.desc("cnt"), "age_group")


def _severity_of(df: DataFrame, filters: Filters, role: str, name: str) -> DataFrame:
    d = filters.apply(df)
    return _by_injury(d, label(role_col(d, role)), name).orderBy(F.desc("cnt"), name, "injury")


def severity_by_gender(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _severity_of(df, filters, "person_sex", "sex")


def ejection_vs_severity(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _severity_of(df, filters, "ejection", "ejection_label")


def position_vs_severity(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _severity_of(df, filters, "position_in_vehicle", "position")


def borough_vs_injury(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    return _by_injury(d, label(role_col(d, "borough")), "borough_label").orderBy("borough_label", "injury")


def person_type_injury_rates(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    groups = d.groupBy(label(role_col(d, "person_type")).alias("person_type_label"))
    out = groups.agg(F.count_if(is_injured(role_col(d, "person_injury"))).alias("injured"), _n().alias("total"))
    return out.withColumn("rate", rate("injured", "total")).orderBy(F.desc("injured"), "person_type_label")


def weekday_weekend_injuries(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    ts = role_col(d, "crash_datetime")
    injured = F.count_if(is_injured(role_col(d, "person_injury"))).alias("injured")
    return d.where(ts.isNotNull()).groupBy(day_type(ts).alias("day_type")).agg(injured).orderBy("day_type")


def motorcycle_vs_car_fatalities(df: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    d = filters.apply(df)
    groups = d.groupBy(vehicle_class(role_col(d, "vehicle_type")).alias("vtype"))
    out = groups.agg(F.count_if(is_fatal(role_col(d, "person_injury"))).alias("fatalities"), _n().alias("total"))
    return out.withColumn("fatality_rate", rate("fatalities", "total")).orderBy("vtype")


def top_vehicles(df: DataFrame, filters: Filters = NO_FILTERS, n: int = 30, style: str = "list") -> DataFrame:
    """Most frequent vehicle types; on a summary the counts are summed."""
    d = filters.apply(df)
    if not has_role(d, "all_vehicle_types") and has_role(d, "vehicle_type"):
        rows = d.groupBy(role_col(d, "vehicle_type").alias("vehicle")).agg(F.sum(quoted(resolve(d, "count"))).alias("cnt"))
        return rows.orderBy(F.desc("cnt"), "vehicle").limit(n)
    return top_labels(d, resolve(d, "all_vehicle_types"), n, style, "vehicle")


def vehicle_trend(df: DataFrame, vehicles: list[str], unit: str = "Month", filters: Filters = NO_FILTERS, style: str = "list") -> DataFrame:
    """Occurrences of the selected vehicles per year, month or day."""
    wanted = [v.strip().lower() for v in vehicles if v and v.strip()]
    d = filters.apply(df)
    text = resolve(d, "all_vehicle_types")
    dated = d.select(trunc_to(role_col(d, "crash_datetime"), unit).alias("period"), F.col(quoted(text)).alias("_text"))
    chosen = F.lower("label").isin(*wanted) if wanted else F.lit(False)
    counts = count_labels(dated, "_text", ["period"], style, where=chosen)
    merged = counts.groupBy("period", F.lower("label").alias("vehicle")).agg(F.sum("cnt").alias("cnt"))
    return merged.orderBy("period", "vehicle")
