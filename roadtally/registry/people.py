"""To whom and how: person-grain questions on persons joined to crashes."""

from __future__ import annotations

from roadtally.operators import questions as q
from roadtally.operators.aggregates import count_by, share_by, sum_by, top_cross
from roadtally.operators.columns import with_date_parts, with_totals
from roadtally.operators.filters import Filters
from roadtally.operators.joins import with_group_size
from roadtally.registry.places import rounded
from roadtally.registry.tables import merged, persons, sql

NOT_INJURED = "('no injury', 'none', 'unknown', '')"
INJURED = f"person_injury IS NOT NULL AND lower(trim(person_injury)) NOT IN {NOT_INJURED}"
FATAL = "(lower(COALESCE(person_injury, '')) LIKE '%kill%' OR lower(COALESCE(person_injury, '')) LIKE '%fatal%')"
AGE = "TRY_CAST(person_age AS INTEGER)"
BAND = f"CASE WHEN {AGE} <= 18 THEN '0-18' WHEN {AGE} <= 30 THEN '19-30' WHEN {AGE} <= 50 THEN '31-50' WHEN {AGE} > 50 THEN '51+' ELSE 'Unknown' END"
SAFETY = "COALESCE(NULLIF(lower(trim(replace(replace(safety_equipment, '[', ''), ']', ''))), ''), 'Unknown')"
VTYPE = (
    "CASE WHEN lower(all_vehicle_types) LIKE '%motor%' OR lower(all_vehicle_types) LIKE '%bike%' THEN 'Motorcycle' "
    "WHEN lower(all_vehicle_types) LIKE '%sedan%' OR lower(all_vehicle_types) LIKE '%car%' OR lower(all_vehicle_types) LIKE '%pass%' "
    "OR lower(all_vehicle_types) LIKE '%auto%' THEN 'Car' ELSE 'Other' END"
)
DAY_TYPE = "CASE WHEN strftime(crash_datetime, '%w') IN ('0', '6') THEN 'Weekend' ELSE 'Weekday' END"
CHOSEN = Filters(person_types=("occupant", "PEDESTRIAN"), sexes=("f",), min_age=10, max_age=60, injured_only=True)
CHOSEN_SQL = (
    "lower(COALESCE(person_type, '')) IN ('occupant', 'pedestrian') AND lower(COALESCE(person_sex, '')) IN ('f') "
    f"AND {AGE} >= 10 AND {AGE} <= 60 AND {INJURED}"
)


def label_sql(c: str, null_if: str = "Unknown") -> str:
    return f"COALESCE(NULLIF(trim({c}), '{null_if}'), 'Unknown')"


def scored(spark, sf):
    return with_totals(merged(spark, sf))


def by_injury(dim: str, name: str, null_if: str = "Unknown", where: str = "TRUE", tail: str = "") -> str:
    return sql(f"SELECT {dim} AS {name}, {label_sql('person_injury', null_if)} AS injury, COUNT(*) AS cnt FROM merged WHERE {where} GROUP BY 1, 2{tail}", "merged")


QUERIES = {
    "safety_vs_injury": (
        lambda s, d: q.safety_vs_injury(merged(s, d)),
        by_injury(SAFETY, "safety", "", tail=" ORDER BY cnt DESC, safety, injury LIMIT 1000"),
    ),
    "injuries_by_hour": (
        lambda s, d: q.injuries_by_hour(merged(s, d)),
        by_injury("CAST(hour(crash_datetime) AS INTEGER)", "hour", "", "crash_datetime IS NOT NULL"),
    ),
    "age_group_counts": (
        lambda s, d: q.age_group_counts(merged(s, d)),
        sql(f"SELECT {BAND} AS age_group, COUNT(*) AS cnt FROM merged GROUP BY 1", "merged"),
    ),
    "age_group_counts_filtered": (
        lambda s, d: q.age_group_counts(merged(s, d), CHOSEN),
        sql(f"SELECT {BAND} AS age_group, COUNT(*) AS cnt FROM merged WHERE {CHOSEN_SQL} GROUP BY 1", "merged"),
    ),
    "severity_by_gender": (lambda s, d: q.severity_by_gender(merged(s, d)), by_injury(label_sql("person_sex"), "sex")),
    "person_type_injury_rates": (
        lambda s, d: rounded(q.person_type_injury_rates(merged(s, d)), "rate"),
        sql(
            f"SELECT {label_sql('person_type')} AS person_type_label, COUNT(*) FILTER (WHERE {INJURED}) AS injured, COUNT(*) AS total, "
            f"round(COUNT(*) FILTER (WHERE {INJURED}) / COUNT(*), 6) AS rate FROM merged GROUP BY 1",
            "merged",
        ),
    ),
    "ejection_vs_severity": (lambda s, d: q.ejection_vs_severity(merged(s, d)), by_injury(label_sql("ejection"), "ejection_label")),
    "position_vs_severity": (lambda s, d: q.position_vs_severity(merged(s, d)), by_injury(label_sql("position_in_vehicle"), "position")),
    "borough_vs_injury": (lambda s, d: q.borough_vs_injury(merged(s, d)), by_injury(label_sql("borough"), "borough_label")),
    "weekday_weekend_injuries": (
        lambda s, d: q.weekday_weekend_injuries(merged(s, d)),
        sql(f"SELECT {DAY_TYPE} AS day_type, COUNT(*) FILTER (WHERE {INJURED}) AS injured FROM merged WHERE crash_datetime IS NOT NULL GROUP BY 1", "merged"),
    ),
    "motorcycle_vs_car_fatalities": (
        lambda s, d: rounded(q.motorcycle_vs_car_fatalities(merged(s, d)), "fatality_rate"),
        sql(
            f"SELECT {VTYPE} AS vtype, COUNT(*) FILTER (WHERE {FATAL}) AS fatalities, COUNT(*) AS total, "
            f"round(COUNT(*) FILTER (WHERE {FATAL}) / COUNT(*), 6) AS fatality_rate FROM merged GROUP BY 1",
            "merged",
        ),
    ),
    "gender_pie": (
        lambda s, d: q.gender_pie(persons(s, d)),
        sql("SELECT person_sex AS sex, COUNT(*) AS cnt FROM persons GROUP BY 1", "persons"),
    ),
    "gender_share": (
        lambda s, d: rounded(share_by(persons(s, d), "person_sex"), "share"),
        sql("SELECT person_sex, COUNT(*) AS cnt, round(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM persons GROUP BY 1", "persons"),
    ),
    "age_histogram": (
        lambda s, d: rounded(q.age_histogram(persons(s, d)), "bin_start", "bin_end"),
        sql(
            "SELECT CAST(least(floor((a - lo) / w), 29) AS INTEGER) AS bin, round(lo + least(floor((a - lo) / w), 29) * w, 6) AS bin_start, "
            "round(lo + least(floor((a - lo) / w), 29) * w + w, 6) AS bin_end, COUNT(*) AS cnt FROM "
            "(SELECT TRY_CAST(person_age AS DOUBLE) AS a FROM persons), (SELECT min(a) AS lo, (max(a) - min(a)) / 30.0 AS w FROM (SELECT TRY_CAST(person_age AS DOUBLE) AS a FROM persons)) "
            "WHERE a IS NOT NULL GROUP BY 1, 2, 3",
            "persons",
        ),
    ),
    "age_box": (
        lambda s, d: rounded(q.age_box(persons(s, d)), "q1", "median", "q3", "lower_whisker", "upper_whisker"),
        sql(
            "SELECT COUNT(a) AS n, MIN(a) AS min, MAX(a) AS max, MIN(a) FILTER (WHERE a >= q1 - 1.5 * (q3 - q1)) AS lower_whisker, "
            "MAX(a) FILTER (WHERE a <= q3 + 1.5 * (q3 - q1)) AS upper_whisker, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3 FROM ages, quart",
            "persons",
            ages="SELECT TRY_CAST(person_age AS DOUBLE) AS a FROM persons",
            quart="SELECT quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS median, quantile_cont(a, 0.75) AS q3 FROM ages",
        ),
    ),
    "count_by_safety_top5": (
        lambda s, d: count_by(persons(s, d), "safety_equipment", 5, count_col="unique_id", keep_null=False),
        sql("SELECT safety_equipment, COUNT(unique_id) AS cnt FROM persons WHERE safety_equipment IS NOT NULL GROUP BY 1 ORDER BY cnt DESC, 1 LIMIT 5", "persons"),
    ),
    "count_by_ejection": (
        lambda s, d: count_by(persons(s, d), "ejection"),
        sql("SELECT ejection, COUNT(*) AS cnt FROM persons GROUP BY 1", "persons"),
    ),
    "person_type_by_ejection": (
        lambda s, d: count_by(persons(s, d), ["person_type", "ejection"], keep_null=False),
        sql("SELECT person_type, ejection, COUNT(*) AS cnt FROM persons WHERE person_type IS NOT NULL AND ejection IS NOT NULL GROUP BY 1, 2", "persons"),
    ),
    "position_by_injury": (
        lambda s, d: count_by(persons(s, d), ["position_in_vehicle", "person_injury"], keep_null=False),
        sql("SELECT position_in_vehicle, person_injury, COUNT(*) AS cnt FROM persons WHERE position_in_vehicle IS NOT NULL AND person_injury IS NOT NULL GROUP BY 1, 2", "persons"),
    ),
    "type_age_position_counts": (
        lambda s, d: count_by(persons(s, d), ["person_type", "person_age", "position_in_vehicle"], keep_null=False),
        sql("SELECT person_type, person_age, position_in_vehicle, COUNT(*) AS cnt FROM persons WHERE person_type IS NOT NULL AND person_age IS NOT NULL AND position_in_vehicle IS NOT NULL GROUP BY 1, 2, 3", "persons"),
    ),
    "five_way_person_counts": (
        lambda s, d: count_by(persons(s, d), ["person_injury", "ejection", "safety_equipment", "person_sex", "person_type"], keep_null=False),
        sql("SELECT person_injury, ejection, safety_equipment, person_sex, person_type, COUNT(*) AS cnt FROM persons WHERE person_injury IS NOT NULL AND ejection IS NOT NULL AND safety_equipment IS NOT NULL AND person_sex IS NOT NULL GROUP BY ALL", "persons"),
    ),
    "injured_by_year_person_type": (
        lambda s, d: sum_by(with_date_parts(scored(s, d)), ["year", "person_type"], ["total_injured"], keep_null=False),
        sql("SELECT CAST(year(crash_datetime) AS INTEGER) AS year, person_type, CAST(SUM(total_injured) AS BIGINT) AS total_injured FROM merged_scored WHERE crash_datetime IS NOT NULL GROUP BY 1, 2", "merged_scored"),
    ),
    "injured_by_position": (
        lambda s, d: sum_by(scored(s, d), "position_in_vehicle", ["total_injured"]),
        sql("SELECT position_in_vehicle, CAST(COALESCE(SUM(total_injured), 0) AS BIGINT) AS total_injured FROM merged_scored GROUP BY 1", "merged_scored"),
    ),
    "top_positions_by_type": (
        lambda s, d: top_cross(persons(s, d), "position_in_vehicle", "person_type", 2),
        sql("SELECT position_in_vehicle, person_type, COUNT(*) AS cnt FROM persons WHERE position_in_vehicle IN (SELECT position_in_vehicle FROM persons WHERE position_in_vehicle IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 2) GROUP BY 1, 2", "persons"),
    ),
    "collision_sizes": (
        lambda s, d: with_group_size(persons(s, d), "collision_id").select("unique_id", "group_size"),
        sql("SELECT unique_id, COUNT(*) OVER (PARTITION BY collision_id) AS group_size FROM persons", "persons"),
    ),
}
