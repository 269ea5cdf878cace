"""Where and when: crash-grain questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.operators import questions as q
from roadtally.operators.aggregates import (
    count_by, count_labels, facet_values, kpis, mean_by, pair_matrix, pivot_top, share_by, sum_by, time_series, top_cross, unpivot,
)
from roadtally.operators.columns import with_date_parts, with_totals
from roadtally.operators.filters import Filters
from roadtally.plans.derive import build_summary
from roadtally.registry.tables import incidents, labels_sql, sql, table


def scored(spark, sf):
    return with_totals(incidents(spark, sf))


def summary(spark, sf):
    return build_summary(incidents(spark, sf))


SUMMARY_SQL = (
    "SELECT COALESCE(borough, 'Unknown') AS borough, CAST(year(crash_datetime) AS INTEGER) AS year, v AS vehicle_type, f AS factor, "
    "COUNT(*) AS count, AVG(severity_score) AS avg_severity, CAST(SUM(total_injured) AS BIGINT) AS sum_injured, "
    "CAST(SUM(total_killed) AS BIGINT) AS sum_killed "
    f"FROM (SELECT *, unnest({labels_sql('all_contributing_factors')}) AS f FROM (SELECT *, unnest({labels_sql('all_vehicle_types')}) AS v FROM scored)) "
    "GROUP BY ALL"
)
DATED = "CAST(date_trunc('{u}', crash_datetime) AS DATE)"
SELECTED = Filters(boroughs=("Manhattan", "Bronx"), years=(1995, 1998))
SELECTED_SQL = "borough IN ('Manhattan', 'Bronx') AND year(crash_datetime) BETWEEN 1995 AND 1998"


def as_text(df, *cols):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def heatmap_events(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("ts", "crash_datetime")
    return q.temporal_heatmap(events)


QUERIES = {
    "weekday_hour_heatmap": (
        heatmap_events,
        "SELECT strftime(ts, '%A') AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS cnt FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
    ),
    "temporal_heatmap": (
        lambda s, d: q.temporal_heatmap(incidents(s, d)),
        sql("SELECT strftime(crash_datetime, '%A') AS day_of_week, CAST(hour(crash_datetime) AS INTEGER) AS hour, COUNT(*) AS cnt FROM incidents WHERE crash_datetime IS NOT NULL GROUP BY 1, 2", "incidents"),
    ),
    "injuries_by_borough": (
        lambda s, d: q.injuries_by_borough(scored(s, d)),
        sql("SELECT borough, CAST(SUM(COALESCE(total_injured, 0)) AS BIGINT) AS total_injured FROM scored GROUP BY borough", "scored"),
    ),
    "injuries_by_borough_filtered": (
        lambda s, d: q.injuries_by_borough(scored(s, d), SELECTED),
        sql(f"SELECT borough, CAST(SUM(COALESCE(total_injured, 0)) AS BIGINT) AS total_injured FROM scored WHERE {SELECTED_SQL} GROUP BY borough", "scored"),
    ),
    "crashes_by_year": (
        lambda s, d: q.crashes_by_year(incidents(s, d)),
        sql("SELECT CAST(year(crash_datetime) AS INTEGER) AS year, borough, COUNT(*) AS crashes FROM incidents GROUP BY 1, 2", "incidents"),
    ),
    "crashes_by_year_filtered": (
        lambda s, d: q.crashes_by_year(incidents(s, d), SELECTED),
        sql(f"SELECT CAST(year(crash_datetime) AS INTEGER) AS year, borough, COUNT(*) AS crashes FROM incidents WHERE {SELECTED_SQL} GROUP BY 1, 2", "incidents"),
    ),
    "map_aggregate_scatter": (
        lambda s, d: rounded(q.map_aggregate_scatter(scored(s, d)), "lat", "lon", "severity_mean", "size"),
        sql(
            "SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, cnt, round(sev, 6) AS severity_mean, "
            "round((cnt - min(cnt) OVER () + 1) / (max(cnt) OVER () - min(cnt) OVER () + 1) * 30 + 5, 6) AS size FROM "
            "(SELECT round(latitude, 3) AS lat, round(longitude, 3) AS lon, COUNT(*) AS cnt, AVG(COALESCE(severity_score, 0)) AS sev "
            "FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2 ORDER BY cnt DESC, lat, lon LIMIT 20000)",
            "scored",
        ),
    ),
    "map_aggregate_scatter_top": (
        lambda s, d: rounded(q.map_aggregate_scatter(scored(s, d), limit=50, precision=2), "lat", "lon", "severity_mean", "size"),
        sql(
            "SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, cnt, round(sev, 6) AS severity_mean, "
            "round((cnt - min(cnt) OVER () + 1) / (max(cnt) OVER () - min(cnt) OVER () + 1) * 30 + 5, 6) AS size FROM "
            "(SELECT round(latitude, 2) AS lat, round(longitude, 2) AS lon, COUNT(*) AS cnt, AVG(COALESCE(severity_score, 0)) AS sev "
            "FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2 ORDER BY cnt DESC, lat, lon LIMIT 50)",
            "scored",
        ),
    ),
    "severity_by_borough": (
        lambda s, d: rounded(q.severity_by_borough(scored(s, d)), "avg_severity"),
        sql("SELECT borough, round(AVG(COALESCE(severity_score, 0)), 6) AS avg_severity FROM scored GROUP BY borough", "scored"),
    ),
    "density_points": (
        lambda s, d: q.density_points(scored(s, d)),
        sql("SELECT latitude, longitude, COALESCE(severity_score, 0) AS severity FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "scored"),
    ),
    "density_grid": (
        lambda s, d: rounded(q.density_grid(scored(s, d)), "lat", "lon"),
        sql("SELECT round(round(latitude, 3), 6) AS lat, round(round(longitude, 3), 6) AS lon, CAST(SUM(severity_score) AS BIGINT) AS severity, COUNT(*) AS cnt FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2", "scored"),
    ),
    "factor_bar": (
        lambda s, d: q.factor_bar(incidents(s, d)),
        sql(f"SELECT f AS factor, COUNT(*) AS cnt FROM (SELECT unnest({labels_sql('all_contributing_factors', False)}) AS f FROM incidents) GROUP BY 1 ORDER BY cnt DESC, factor LIMIT 15", "incidents"),
    ),
    "factor_bar_comma": (
        lambda s, d: q.factor_bar(incidents(s, d), style="comma"),
        sql("SELECT trim(f) AS factor, COUNT(*) AS cnt FROM (SELECT unnest(string_split(COALESCE(all_contributing_factors, ''), ',')) AS f FROM incidents) GROUP BY 1 ORDER BY cnt DESC, factor LIMIT 15", "incidents"),
    ),
    "factor_bar_summary": (
        lambda s, d: q.factor_bar(summary(s, d), top_n=30),
        sql("SELECT factor, CAST(SUM(count) AS BIGINT) AS cnt FROM summary WHERE factor IS NOT NULL GROUP BY factor ORDER BY cnt DESC, factor LIMIT 30", "scored", summary=SUMMARY_SQL),
    ),
    "factor_bar_summary_rows": (
        lambda s, d: q.factor_bar(summary(s, d), top_n=30, weighted=False),
        sql("SELECT factor, COUNT(*) AS cnt FROM summary WHERE factor IS NOT NULL GROUP BY factor ORDER BY cnt DESC, factor LIMIT 30", "scored", summary=SUMMARY_SQL),
    ),
    "top_vehicles": (
        lambda s, d: q.top_vehicles(incidents(s, d)),
        sql(f"SELECT v AS vehicle, COUNT(*) AS cnt FROM (SELECT unnest({labels_sql('all_vehicle_types', False)}) AS v FROM incidents) GROUP BY 1 ORDER BY cnt DESC, vehicle LIMIT 30", "incidents"),
    ),
    "top_vehicles_comma": (
        lambda s, d: q.top_vehicles(incidents(s, d), style="comma"),
        sql("SELECT trim(v) AS vehicle, COUNT(*) AS cnt FROM (SELECT unnest(string_split(COALESCE(all_vehicle_types, ''), ',')) AS v FROM incidents) GROUP BY 1 ORDER BY cnt DESC, vehicle LIMIT 30", "incidents"),
    ),
    "top_vehicles_summary": (
        lambda s, d: q.top_vehicles(summary(s, d)),
        sql("SELECT vehicle_type AS vehicle, CAST(SUM(count) AS BIGINT) AS cnt FROM summary GROUP BY 1 ORDER BY cnt DESC, vehicle LIMIT 30", "scored", summary=SUMMARY_SQL),
    ),
    "vehicle_factor_pairs": (
        lambda s, d: pair_matrix(incidents(s, d), "all_vehicle_types", "all_contributing_factors"),
        sql(f"SELECT v AS vehicle, f AS factor, COUNT(*) AS cnt FROM (SELECT v, unnest(fs) AS f FROM (SELECT unnest({labels_sql('all_vehicle_types', False)}) AS v, {labels_sql('all_contributing_factors', False)} AS fs FROM incidents)) GROUP BY 1, 2", "incidents"),
    ),
    "vehicle_list_counts": (
        lambda s, d: count_labels(incidents(s, d), "all_vehicle_types", ["borough"], name="vehicle"),
        sql(f"SELECT borough, v AS vehicle, COUNT(*) AS cnt FROM (SELECT borough, unnest({labels_sql('all_vehicle_types', False)}) AS v FROM incidents) GROUP BY 1, 2", "incidents"),
    ),
    "vehicle_share": (
        lambda s, d: rounded(share_by(count_labels(incidents(s, d), "all_vehicle_types", name="vehicle"), "vehicle", "cnt"), "share"),
        sql(f"SELECT v AS vehicle, COUNT(*) AS cnt, round(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM (SELECT unnest({labels_sql('all_vehicle_types', False)}) AS v FROM incidents) GROUP BY 1", "incidents"),
    ),
    "time_series_month": (
        lambda s, d: as_text(time_series(incidents(s, d), "crash_datetime", "Month"), "period"),
        sql("SELECT strftime(p, '%Y-%m-%d') AS period, COUNT(collision_id) AS cnt FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(crash_datetime)) FROM incidents)::TIMESTAMP, (SELECT date_trunc('month', max(crash_datetime)) FROM incidents)::TIMESTAMP, INTERVAL 1 MONTH)) AS p) LEFT JOIN incidents ON date_trunc('month', crash_datetime) = p GROUP BY 1", "incidents"),
    ),
    "time_series_month_end": (
        lambda s, d: as_text(time_series(incidents(s, d), "crash_datetime", "Month", label="end"), "period"),
        sql("SELECT strftime(last_day(p), '%Y-%m-%d') AS period, COUNT(collision_id) AS cnt FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(crash_datetime)) FROM incidents)::TIMESTAMP, (SELECT date_trunc('month', max(crash_datetime)) FROM incidents)::TIMESTAMP, INTERVAL 1 MONTH)) AS p) LEFT JOIN incidents ON date_trunc('month', crash_datetime) = p GROUP BY 1", "incidents"),
    ),
    "time_series_day": (
        lambda s, d: as_text(time_series(incidents(s, d), "crash_datetime", "Day"), "period"),
        sql("SELECT strftime(p, '%Y-%m-%d') AS period, COUNT(collision_id) AS cnt FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(crash_datetime)) FROM incidents)::TIMESTAMP, (SELECT date_trunc('day', max(crash_datetime)) FROM incidents)::TIMESTAMP, INTERVAL 1 DAY)) AS p) LEFT JOIN incidents ON date_trunc('day', crash_datetime) = p GROUP BY 1", "incidents"),
    ),
    "kpis": (
        lambda s, d: rounded(kpis(scored(s, d), "collision_id"), "injured_per_crash"),
        sql("SELECT COUNT(*) AS crashes, CAST(SUM(total_injured) AS BIGINT) AS injured, CAST(SUM(total_killed) AS BIGINT) AS killed, COUNT(DISTINCT collision_id) AS distinct_crashes, round(SUM(total_injured) / COUNT(*), 6) AS injured_per_crash FROM scored", "scored"),
    ),
    "count_by_borough": (
        lambda s, d: count_by(incidents(s, d), "borough", keep_null=False),
        sql("SELECT borough, COUNT(*) AS cnt FROM incidents WHERE borough IS NOT NULL GROUP BY 1", "incidents"),
    ),
    "totals_by_borough": (
        lambda s, d: sum_by(scored(s, d), "borough", ["total_injured", "total_killed"]),
        sql("SELECT borough, CAST(SUM(total_injured) AS BIGINT) AS total_injured, CAST(SUM(total_killed) AS BIGINT) AS total_killed FROM scored GROUP BY 1", "scored"),
    ),
    "totals_by_year": (
        lambda s, d: sum_by(with_date_parts(scored(s, d)), "year", ["total_injured", "total_killed"]),
        sql("SELECT CAST(year(crash_datetime) AS INTEGER) AS year, CAST(SUM(total_injured) AS BIGINT) AS total_injured, CAST(SUM(total_killed) AS BIGINT) AS total_killed FROM scored GROUP BY 1", "scored"),
    ),
    "date_parts": (
        lambda s, d: with_date_parts(incidents(s, d)).select("collision_id", "year", "month", "hour", "day_of_week", "day_number"),
        sql("SELECT collision_id, CAST(year(crash_datetime) AS INTEGER) AS year, CAST(month(crash_datetime) AS INTEGER) AS month, CAST(hour(crash_datetime) AS INTEGER) AS hour, strftime(crash_datetime, '%A') AS day_of_week, CAST(isodow(crash_datetime) - 1 AS INTEGER) AS day_number FROM incidents", "incidents"),
    ),
    "severity_scores": (
        lambda s, d: scored(s, d).select("collision_id", "total_injured", "total_killed", "severity_score"),
        sql("SELECT collision_id, total_injured, total_killed, severity_score FROM scored", "scored"),
    ),
    "exploded_summary": (
        lambda s, d: rounded(summary(s, d), "avg_severity"),
        sql("SELECT borough, year, vehicle_type, factor, count, round(avg_severity, 6) AS avg_severity, sum_injured, sum_killed FROM summary", "scored", summary=SUMMARY_SQL),
    ),
    "exploded_summary_split": (
        lambda s, d: rounded(build_summary(incidents(s, d), style="split"), "avg_severity"),
        sql(
            "SELECT COALESCE(borough, 'Unknown') AS borough, CAST(year(crash_datetime) AS INTEGER) AS year, trim(v) AS vehicle_type, trim(f) AS factor, COUNT(*) AS count, "
            "round(AVG(severity_score), 6) AS avg_severity, CAST(SUM(total_injured) AS BIGINT) AS sum_injured, CAST(SUM(total_killed) AS BIGINT) AS sum_killed "
            "FROM (SELECT *, unnest(string_split(COALESCE(all_contributing_factors, ''), ',')) AS f FROM (SELECT *, unnest(string_split(COALESCE(all_vehicle_types, ''), ',')) AS v FROM scored)) "
            "WHERE trim(v) <> '' AND trim(f) <> '' GROUP BY ALL",
            "scored",
        ),
    ),
    "vehicles_by_year_top8": (
        lambda s, d: unpivot(pivot_top(summary(s, d), "year", "vehicle_type", "count", 8), ["year"], name="vehicle", value="cnt"),
        sql(
            "SELECT y.year, t.vehicle_type AS vehicle, CAST(COALESCE(SUM(s.count), 0) AS BIGINT) AS cnt FROM (SELECT DISTINCT year FROM summary) y CROSS JOIN "
            "(SELECT vehicle_type FROM summary GROUP BY 1 ORDER BY SUM(count) DESC, vehicle_type LIMIT 8) t "
            "LEFT JOIN summary s ON s.year = y.year AND s.vehicle_type = t.vehicle_type GROUP BY 1, 2",
            "scored", summary=SUMMARY_SQL,
        ),
    ),
    "factors_by_borough_top12": (
        lambda s, d: unpivot(pivot_top(summary(s, d), "borough", "factor", "count", 12), ["borough"], name="factor_name", value="cnt"),
        sql(
            "SELECT y.borough, t.factor AS factor_name, CAST(COALESCE(SUM(s.count), 0) AS BIGINT) AS cnt FROM (SELECT DISTINCT borough FROM summary) y CROSS JOIN "
            "(SELECT factor FROM summary GROUP BY 1 ORDER BY SUM(count) DESC, factor LIMIT 12) t "
            "LEFT JOIN summary s ON s.borough = y.borough AND s.factor = t.factor GROUP BY 1, 2",
            "scored", summary=SUMMARY_SQL,
        ),
    ),
    "mean_severity_by_vehicle": (
        lambda s, d: rounded(mean_by(summary(s, d), "vehicle_type", "avg_severity", 20), "mean"),
        sql("SELECT vehicle_type, round(AVG(avg_severity), 6) AS mean FROM summary GROUP BY 1", "scored", summary=SUMMARY_SQL),
    ),
    "mean_severity_by_borough": (
        lambda s, d: rounded(mean_by(summary(s, d), "borough", "avg_severity"), "mean"),
        sql("SELECT borough, round(AVG(avg_severity), 6) AS mean FROM summary GROUP BY 1", "scored", summary=SUMMARY_SQL),
    ),
    "facet_values": (
        lambda s, d: facet_values(incidents(s, d), "borough"),
        sql("SELECT DISTINCT trim(borough) AS value FROM incidents WHERE trim(borough) <> ''", "incidents"),
    ),
    "orders_per_status_top_priority": (
        lambda s, d: top_cross(table(s, d, "orders"), "o_orderpriority", "o_orderstatus", 3),
        "SELECT o_orderpriority, o_orderstatus, COUNT(*) AS cnt FROM orders WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 3) GROUP BY 1, 2",
    ),
}
for _unit in ("Year", "Month", "Day"):
    QUERIES[f"vehicle_trend_{_unit.lower()}"] = (
        lambda s, d, u=_unit: as_text(q.vehicle_trend(incidents(s, d), ["Sedan", "TAXI "], u), "period"),
        sql(
            f"SELECT strftime({DATED.format(u=_unit.lower())}, '%Y-%m-%d') AS period, lower(v) AS vehicle, COUNT(*) AS cnt FROM "
            f"(SELECT crash_datetime, unnest({labels_sql('all_vehicle_types', False)}) AS v FROM incidents) WHERE lower(v) IN ('sedan', 'taxi') GROUP BY 1, 2",
            "incidents",
        ),
    )
