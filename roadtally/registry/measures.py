"""Statistics, profiles, quality checks and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.functions.text import clean_text, is_digits
from roadtally.functions.temporal import order_by_list
from roadtally.operators import filters as flt
from roadtally.operators import stats
from roadtally.operators.aggregates import count_by, top_k, value_counts
from roadtally.operators.columns import drop_sparse, null_rates
from roadtally.operators.joins import keep_top, min_max_scale, unmapped
from roadtally.operators.quality import inconsistent, person_rules, reconcile, rule_report
from roadtally.operators.sets import concat, distinct_rows, head, stack, tail
from roadtally.functions.factors import FACTOR_LABELS
from roadtally.plans.derive import build_facets, build_locations, build_summary
from roadtally.registry.places import SUMMARY_SQL, rounded
from roadtally.registry.tables import incidents, merged, persons, raw_crashes, raw_persons, sql, table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def correlations(s, d):
    lines = table(s, d, "lineitem").withColumn("constant", F.lit(1.0))
    return stats.correlation_matrix(lines, [*NUMBERS, "constant"]).withColumn("corr", F.round("corr", 9))


def correlations_sql() -> str:
    cols = [*NUMBERS, "constant"]
    one = " UNION ALL ".join(
        f"SELECT '{a}' AS col_x, '{b}' AS col_y, CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE round(corr({a}, {b}), 9) END AS corr FROM lines"
        for a in cols
        for b in cols
    )
    return f"WITH lines AS (SELECT *, 1.0::DOUBLE AS constant FROM lineitem) {one}"


def describe_sql(cols: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, round(AVG({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, MIN({c}) AS min, "
        f"round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, MAX({c}) AS max FROM {source}"
        for c in cols
    )


def null_sql(cols: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, round((COUNT(*) - COUNT({c})) / COUNT(*), 6) AS null_rate FROM {source}" for c in cols
    )


RAW_PERSON_COLS = ["person_id", "person_injury", "vehicle_id", "person_age", "position_in_vehicle", "ejection", "complaint", "contributing_factor_1", "contributing_factor_2"]
PROFILE_COLS = ["person_type", "person_sex", "ejection", "person_age"]
RAW_RULES_SQL = {
    "invalid_age": "person_age <= 0 OR person_age >= 120",
    "ejected_not_injured": "ejection = 'Ejected' AND person_injury = 'Unspecified'",
    "non_pedestrian_with_pedestrian_data": "person_type IS DISTINCT FROM 'Pedestrian' AND (ped_location IS NOT NULL OR ped_action IS NOT NULL OR ped_role IS NOT NULL)",
    "pedestrian_without_pedestrian_data": "person_type = 'Pedestrian' AND ped_location IS NULL AND ped_action IS NULL AND ped_role IS NULL",
    "pedestrian_in_vehicle": "person_type = 'Pedestrian' AND position_in_vehicle IS DISTINCT FROM 'Does Not Apply'",
    "unspecified_without_detail": "person_injury = 'Unspecified' AND emotional_status = 'Does Not Apply' AND bodily_injury = 'Does Not Apply' AND complaint = 'Does Not Apply'",
}
FACETS_SQL = (
    "SELECT DISTINCT 'boroughs' AS facet, borough AS value FROM summary UNION SELECT DISTINCT 'years', CAST(year AS VARCHAR) FROM summary WHERE year IS NOT NULL "
    "UNION SELECT DISTINCT 'vehicle_types', vehicle_type FROM summary UNION SELECT DISTINCT 'factors', factor FROM summary"
)
KNOWN = [*FACTOR_LABELS.values()]
KNOWN_SQL = ", ".join("'" + k + "'" for k in sorted(set(KNOWN)))


def sampled(s, d, n=100):
    return flt.sample_n(incidents(s, d), n, ["collision_id"]).select("collision_id")


def searched(s, d):
    parts = table(s, d, "part")
    return flt.search(parts, "RED", ["p_name", "p_type"], "p_size").select("p_partkey", "p_name", "p_type", "p_size")


def searched_documents(s, d):
    return flt.search(table(s, d, "documents"), "The ", ["text", "lang"]).select("doc_id")


def sparse_columns(s, d):
    raw = raw_persons(s, d)
    kept = drop_sparse(raw)
    rates = null_rates(raw)
    return s.createDataFrame([(c, round(rates[c], 6)) for c in raw.columns if c not in kept.columns], "dropped string, null_rate double")


def weekday_ordered(s, d):
    days = incidents(s, d).groupBy(F.date_format("crash_datetime", "EEEE").alias("day")).count()
    return days.select("day", "count", order_by_list("day").cast("int").alias("place"))


QUERIES = {
    "correlation_matrix": (correlations, correlations_sql()),
    "describe_lineitem": (
        lambda s, d: rounded(stats.describe(table(s, d, "lineitem"), NUMBERS), "mean", "std", "q1", "median", "q3"),
        describe_sql(NUMBERS, "lineitem"),
    ),
    "price_box": (
        lambda s, d: rounded(stats.box_stats(table(s, d, "lineitem"), "l_extendedprice"), "q1", "median", "q3"),
        "WITH quart AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem) "
        "SELECT COUNT(*) AS n, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max, MIN(l_extendedprice) FILTER (WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1)) AS lower_whisker, "
        "MAX(l_extendedprice) FILTER (WHERE l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS upper_whisker, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3 FROM lineitem, quart",
    ),
    "iqr_outliers": (
        lambda s, d: stats.iqr_outliers(table(s, d, "events"), "value", 1.0).select("event_id", "value"),
        "SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) WHERE value < q1 - 1.0 * (q3 - q1) OR value > q3 + 1.0 * (q3 - q1)",
    ),
    "impute_mean_age": (
        lambda s, d: rounded(stats.impute_mean(raw_persons(s, d), "person_age", 0, 120).select("unique_id", "person_age"), "person_age"),
        sql("SELECT unique_id, round(CASE WHEN person_age > 0 AND person_age < 120 THEN person_age ELSE (SELECT AVG(person_age) FROM raw_persons WHERE person_age > 0 AND person_age < 120) END, 6) AS person_age FROM raw_persons", "raw_persons"),
    ),
    "mode_by_group": (
        lambda s, d: stats.mode_by_group(raw_persons(s, d), "bodily_injury", "complaint"),
        sql("SELECT bodily_injury, complaint AS mode FROM (SELECT *, row_number() OVER (PARTITION BY bodily_injury ORDER BY n DESC, complaint) AS r FROM (SELECT bodily_injury, complaint, COUNT(*) AS n FROM raw_persons WHERE bodily_injury IS NOT NULL AND complaint IS NOT NULL GROUP BY 1, 2)) WHERE r = 1", "raw_persons"),
    ),
    "null_profile": (
        lambda s, d: rounded(stats.null_profile(raw_persons(s, d), RAW_PERSON_COLS), "null_rate"),
        sql(null_sql(RAW_PERSON_COLS, "raw_persons"), "raw_persons"),
    ),
    "null_profile_top3": (
        lambda s, d: rounded(stats.null_profile(raw_persons(s, d), RAW_PERSON_COLS, 3), "null_rate"),
        sql(f'SELECT * FROM ({null_sql(RAW_PERSON_COLS, "raw_persons")}) ORDER BY nulls DESC, "column" LIMIT 3', "raw_persons"),
    ),
    "distinct_profile": (
        lambda s, d: stats.distinct_profile(persons(s, d), PROFILE_COLS).select("column", "distinct_values", F.array_join("values", "|").alias("values")),
        sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS distinct_values, CASE WHEN COUNT(DISTINCT {c}) <= 50 THEN array_to_string(list_sort(list(DISTINCT {c})), '|') END AS \"values\" FROM persons WHERE {c} IS NOT NULL"
                for c in PROFILE_COLS
            ),
            "persons",
        ),
    ),
    "factor_value_counts": (
        lambda s, d: value_counts(raw_crashes(s, d).select(*[clean_text(f"factor_{i}").alias(f"f{i}") for i in range(1, 6)]), [f"f{i}" for i in range(1, 6)], 50),
        sql("SELECT value, COUNT(*) AS cnt FROM (" + " UNION ALL ".join(f"SELECT lower(trim(factor_{i})) AS value FROM raw_crashes" for i in range(1, 6)) + ") WHERE value IS NOT NULL GROUP BY 1 ORDER BY cnt DESC, value LIMIT 50", "raw_crashes"),
    ),
    "unmapped_factors": (
        lambda s, d: unmapped(raw_crashes(s, d).select(clean_text("factor_1").alias("factor")), "factor", KNOWN),
        sql(f"SELECT DISTINCT lower(trim(factor_1)) AS factor FROM raw_crashes WHERE factor_1 IS NOT NULL AND lower(trim(factor_1)) NOT IN ({KNOWN_SQL})", "raw_crashes"),
    ),
    "inconsistent_collisions": (
        lambda s, d: inconsistent(persons(s, d), "collision_id", ["person_type", "ejection", "person_sex"]),
        sql(
            "SELECT collision_id, " + ", ".join(f"COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 1 AS {c}" for c in ("person_type", "ejection", "person_sex"))
            + " FROM persons GROUP BY 1 HAVING person_type OR ejection OR person_sex".replace("person_type OR ejection OR person_sex", " OR ".join(f"COUNT(DISTINCT persons.{c}) + MAX(CASE WHEN persons.{c} IS NULL THEN 1 ELSE 0 END) > 1" for c in ("person_type", "ejection", "person_sex"))),
            "persons",
        ),
    ),
    "rule_violations": (
        lambda s, d: rule_report(raw_persons(s, d), person_rules()),
        sql(" UNION ALL ".join(f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {c}) AS violations FROM raw_persons" for n, c in RAW_RULES_SQL.items()), "raw_persons"),
    ),
    "reconcile": (
        lambda s, d: reconcile(build_locations(incidents(s, d)), build_summary(incidents(s, d)), incidents(s, d)),
        sql(
            "SELECT 'location_rows' AS measure, COUNT(*) AS value FROM incidents WHERE latitude IS NOT NULL AND longitude IS NOT NULL UNION ALL SELECT 'summary_rows', COUNT(*) FROM summary "
            "UNION ALL SELECT 'summary_count', CAST(SUM(count) AS BIGINT) FROM summary UNION ALL SELECT 'vehicle_types', COUNT(DISTINCT vehicle_type) FROM summary UNION ALL SELECT 'raw_rows', COUNT(*) FROM incidents",
            "scored", summary=SUMMARY_SQL,
        ),
    ),
    "locations": (
        lambda s, d: build_locations(incidents(s, d)).drop("full_address").withColumn("crash_datetime", F.date_format("crash_datetime", "yyyy-MM-dd HH:mm:ss")),
        sql("SELECT latitude, longitude, COALESCE(borough, 'Unknown') AS borough, CAST(year(crash_datetime) AS INTEGER) AS year, severity_score, strftime(crash_datetime, '%Y-%m-%d %H:%M:%S') AS crash_datetime FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "scored"),
    ),
    "facets": (lambda s, d: build_facets(incidents(s, d)), sql(FACETS_SQL, "scored", summary=SUMMARY_SQL)),
    "hotspots": (lambda s, d: stats.hotspots(incidents(s, d)), None),
    "sample_points": (lambda s, d: flt.sample(incidents(s, d), 0.05).select("collision_id"), None),
    "sample_n_points": (
        sampled,
        sql("SELECT collision_id FROM incidents ORDER BY ('0x' || substr(md5('42|' || collision_id), 1, 12))::BIGINT, collision_id LIMIT 100", "incidents"),
    ),
    "search_parts": (
        searched,
        "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE contains(lower(p_name), 'red') OR contains(lower(p_type), 'red') OR contains(CAST(p_size AS VARCHAR), 'red')",
    ),
    "search_documents": (
        searched_documents,
        "SELECT doc_id FROM documents WHERE COALESCE(contains(lower(text), 'the '), FALSE) OR COALESCE(contains(lower(lang), 'the '), FALSE)",
    ),
    "year_range_lines": (
        lambda s, d: table(s, d, "lineitem").where(flt.year_between(table(s, d, "lineitem"), "l_shipdate", 1996, 1997)).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("cnt")),
        "SELECT l_returnflag, COUNT(*) AS cnt FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1997 GROUP BY 1",
    ),
    "membership_ci": (
        lambda s, d: count_by(incidents(s, d).where(flt.in_set_ci(F.trim("borough"), ["BROOKLYN", "queens"])), "borough"),
        sql("SELECT borough, COUNT(*) AS cnt FROM incidents WHERE lower(COALESCE(trim(borough), '')) IN ('brooklyn', 'queens') GROUP BY 1", "incidents"),
    ),
    "not_future": (
        lambda s, d: flt.not_future(incidents(s, d), "crash_datetime", "1998-01-01").select("collision_id"),
        sql("SELECT collision_id FROM incidents WHERE crash_datetime <= TIMESTAMP '1998-01-01'", "incidents"),
    ),
    "zero_coordinates_dropped": (
        lambda s, d: flt.drop_zero_coords(raw_crashes(s, d)).select("row_id"),
        sql("SELECT row_id FROM raw_crashes WHERE NOT COALESCE(latitude = 0 AND longitude = 0, FALSE)", "raw_crashes"),
    ),
    "digit_zips": (
        lambda s, d: count_by(raw_crashes(s, d).where(is_digits("zip_code")), "zip_code"),
        sql("SELECT zip_code, COUNT(*) AS cnt FROM raw_crashes WHERE regexp_full_match(zip_code, '[0-9]+') GROUP BY 1", "raw_crashes"),
    ),
    "uninformative_dropped": (
        lambda s, d: flt.drop_uninformative(raw_crashes(s, d), ["factor_1", "factor_2", "factor_3"]).select("row_id"),
        sql("SELECT row_id FROM raw_crashes WHERE NOT (" + " AND ".join(f"(factor_{i} IS NULL OR lower(trim(factor_{i})) = 'unspecified')" for i in (1, 2, 3)) + ")", "raw_crashes"),
    ),
    "sparse_columns": (sparse_columns, sql(f"SELECT \"column\" AS dropped, null_rate FROM ({null_sql(['contributing_factor_1', 'contributing_factor_2'], 'raw_persons')}) WHERE null_rate > 0.8", "raw_persons")),
    "group_rows": (
        lambda s, d: flt.group_rows(persons(s, d), "collision_id", 7).select("unique_id", "collision_id"),
        sql("SELECT unique_id, collision_id FROM persons WHERE collision_id = 7", "persons"),
    ),
    "coordinates_split": (
        lambda s, d: concat([df.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("cnt")) for n, df in zip(("located", "failed"), flt.split_by(incidents(s, d), flt.has_coordinates()))]),
        sql("SELECT CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'located' ELSE 'failed' END AS part, COUNT(*) AS cnt FROM incidents GROUP BY 1", "incidents"),
    ),
    "top_types": (
        lambda s, d: top_k(table(s, d, "part"), "p_type", 3),
        "SELECT p_type, COUNT(*) AS cnt FROM part GROUP BY 1 ORDER BY cnt DESC, p_type LIMIT 3",
    ),
    "rows_of_top_brands": (
        lambda s, d: keep_top(table(s, d, "part"), "p_brand", 5).select("p_partkey", "p_brand"),
        "SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 5)",
    ),
    "scaled_prices": (
        lambda s, d: rounded(min_max_scale(table(s, d, "part"), "p_retailprice", "size").select("p_partkey", "size"), "size"),
        "SELECT p_partkey, round((p_retailprice - lo + 1) / (hi - lo + 1) * 30 + 5, 6) AS size FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)",
    ),
    "weekday_order": (
        weekday_ordered,
        sql("SELECT strftime(crash_datetime, '%A') AS day, COUNT(*) AS count, CAST(isodow(any_value(crash_datetime)) AS INTEGER) AS place FROM incidents GROUP BY 1", "incidents"),
    ),
    "first_rows": (lambda s, d: head(table(s, d, "customer"), 10, ["c_custkey"]), "SELECT * FROM customer ORDER BY c_custkey LIMIT 10"),
    "last_rows": (lambda s, d: tail(table(s, d, "customer"), 10, ["c_custkey"]), "SELECT * FROM customer ORDER BY c_custkey DESC LIMIT 10"),
    "distinct_rows": (
        lambda s, d: distinct_rows(table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")),
        "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem",
    ),
    "stacked_columns": (
        lambda s, d: count_by(stack(persons(s, d), ["person_injury", "ejection"]), ["column", "value"]),
        sql("SELECT \"column\", value, COUNT(*) AS cnt FROM (SELECT 'person_injury' AS \"column\", person_injury AS value FROM persons UNION ALL SELECT 'ejection', ejection FROM persons) GROUP BY 1, 2", "persons"),
    ),
    "union_of_schemas": (
        lambda s, d: count_by(concat([incidents(s, d).select("collision_id", "borough"), persons(s, d).select("collision_id", "person_sex")]), ["borough", "person_sex"]),
        sql("SELECT borough, person_sex, COUNT(*) AS cnt FROM (SELECT borough, NULL AS person_sex FROM incidents UNION ALL SELECT NULL, person_sex FROM persons) GROUP BY 1, 2", "incidents", "persons"),
    ),
    "person_crash_join": (
        lambda s, d: merged(s, d).select("unique_id", "collision_id", "borough", "persons_injured", "all_vehicle_types"),
        sql("SELECT unique_id, collision_id, borough, persons_injured, all_vehicle_types FROM merged", "merged"),
    ),
}
