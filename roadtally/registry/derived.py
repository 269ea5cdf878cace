"""Places by polygon, written tables, materialised answers and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.operators.aggregates import count_by
from roadtally.operators.filters import Filters
from roadtally.operators.spatial import fill_place, locate, nearest_polygon, point_in_polygon
from roadtally.plans import materialize as mat
from roadtally.plans.crashes import clean_crashes, clean_streets, finish_places
from roadtally.plans.derive import build_facets
from roadtally.registry.cleaning import FACTORS_BODY, GEOCODE_STEPS, coordinates_sql, filled_sql, geocodes
from roadtally.registry.people import BAND
from roadtally.registry.places import SUMMARY_SQL, rounded
from roadtally.registry.tables import (
    BOXES, boxes, incidents, incidents_stream, merged, persons, raw_crashes, raw_crashes_stream, sql, zip_boxes,
)
from roadtally.session import scratch_dir
from roadtally.sources import facets as fc
from roadtally.sources.readers import read_csv
from roadtally.sources.writers import rewrite_partitioned, write_csv
from roadtally.streaming.enrich import enrich_stream
from roadtally.streaming.summary import read_summary, stream_summary

RADIUS = 6378137.0


def box_of(ring) -> tuple[float, float, float, float]:
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return min(xs), min(ys), max(xs), max(ys)


def boxes_sql() -> str:
    rows = ", ".join(f"({i}, '{n}', CAST({w} AS DOUBLE), CAST({s} AS DOUBLE), CAST({e} AS DOUBLE), CAST({t} AS DOUBLE))" for i, (n, ring) in enumerate(BOXES) for w, s, e, t in [box_of(ring)])
    return f"SELECT * FROM (VALUES {rows}) AS b(place, name, w, s, e, n)"


ZIPS_SQL = "SELECT * FROM (VALUES (0, '10001', -74.25::DOUBLE, 40.5::DOUBLE, -74.0::DOUBLE, 40.9::DOUBLE), (1, '10002', -73.99::DOUBLE, 40.5::DOUBLE, -73.70::DOUBLE, 40.9::DOUBLE)) AS b(place, name, w, s, e, n)"


def within_sql(points: str, layer: str, key: str) -> str:
    return (
        f"SELECT p.{key}, arg_min(b.name, b.place) AS name FROM {points} p LEFT JOIN {layer} b "
        f"ON longitude > w AND longitude < e AND latitude > s AND latitude < n GROUP BY p.{key}"
    )


def mx(c: str) -> str:
    return f"radians({c}) * {RADIUS}"


def my(c: str) -> str:
    return f"ln(tan(radians({c}) / 2 + pi() / 4)) * {RADIUS}"


def near_sql(points: str, layer: str, key: str) -> str:
    """Distance to the nearest box outline of each located point, for points outside the boxes."""
    return (
        f"SELECT {key}, place, name, sqrt(dx * dx + dy * dy) AS m FROM (SELECT p.{key}, b.place, b.name, "
        f"greatest({mx('w')} - {mx('longitude')}, 0, {mx('longitude')} - {mx('e')}) AS dx, "
        f"greatest({my('s')} - {my('latitude')}, 0, {my('latitude')} - {my('n')}) AS dy FROM {points} p, {layer} b WHERE latitude IS NOT NULL)"
    )


def located_sql(points: str, layer: str, key: str, max_m: float) -> str:
    return (
        f"SELECT w.{key}, COALESCE(w.name, arg_min(d.name, (round(d.m, 6), d.place)) FILTER (WHERE d.m <= {max_m})) AS name "
        f"FROM ({within_sql(points, layer, key)}) w LEFT JOIN ({near_sql(points, layer, key)}) d ON w.{key} = d.{key} GROUP BY w.{key}, w.name"
    )


def outside(s, d):
    placed = point_in_polygon(incidents(s, d), boxes(s), "inside")
    near = nearest_polygon(placed, boxes(s), "borough_near", 800.0, distance="metres", only=F.col("inside").isNull())
    return near.where("borough_near is not null").select("collision_id", "borough_near", F.round("metres", 2).alias("metres"))


def finished(s, d):
    out = finish_places(raw_crashes(s, d), boxes(s), zip_boxes(s), 800.0)
    return out.select("row_id", "borough", "zip_code")


def whole_pipeline(s, d):
    out = clean_crashes(raw_crashes(s, d), boxes(s), zip_boxes(s), geocodes(s, d), order=["row_id"])
    return out.select("collision_id", "row_id", "borough", "zip_code", "full_address", "all_contributing_factors_str")


def materialised(s, d, name, filters=Filters()):
    folder = scratch_dir(s, "answers")
    table = merged(s, d)
    mat.materialize(table, folder)
    return mat.answer(s, name, table, folder, filters)


def answer_sizes(s, d):
    cells = mat.answer_cells(merged(s, d))
    return cells.groupBy("question").agg(F.count(F.lit(1)).alias("cells"), F.sum("cnt").alias("cnt"), F.sum("injured").alias("injured"), F.sum("fatalities").alias("fatalities"))


def rewritten(s, d):
    out = scratch_dir(s, "by-year")
    rewrite_partitioned(incidents(s, d), out, ["YEAR"], max_rows=2000)
    return count_by(s.read.parquet(out).select(F.col("YEAR").cast("int").alias("year"), "borough"), ["year", "borough"])


def rewrite_rows(s, d):
    out = scratch_dir(s, "report")
    return rewrite_partitioned(incidents(s, d), out, ["YEAR"]).select("rows")


def csv_round_trip(s, d):
    out = scratch_dir(s, "csv")
    write_csv(persons(s, d).select("unique_id", "person_injury", "person_age"), out)
    back = read_csv(s, out)
    return count_by(back.select("person_injury", F.col("person_age").try_cast("double").alias("age")), ["person_injury", "age"])


def facet_table(s, d):
    return fc.key_value(fc.facet_document(build_facets(incidents(s, d))))


def facets_loaded(s, d):
    folder = scratch_dir(s, "facets")
    fc.write_facets(build_facets(incidents(s, d)), folder)
    return fc.load_facets(s, folder)


def summary_streamed(s, d):
    folder = scratch_dir(s, "summary")
    stream_summary(incidents_stream(s, d), folder, scratch_dir(s, "summary-progress"))
    return rounded(read_summary(s, folder), "avg_severity")


def coordinates_streamed(s, d):
    folder = scratch_dir(s, "enriched")
    enrich_stream(clean_streets(raw_crashes_stream(s, d)), geocodes(s, d), folder, scratch_dir(s, "enriched-progress"), row_id="row_id")
    return s.read.parquet(folder).select("row_id", "latitude", "longitude")


def key_sql(name: str, c: str, cast: str = "") -> str:
    return f"SELECT '{name}' AS key, CAST(to_json(list_sort(list(DISTINCT {c}{cast}))) AS VARCHAR) AS value FROM summary WHERE {c} IS NOT NULL"


QUERIES = {
    "point_in_polygon": (
        lambda s, d: point_in_polygon(incidents(s, d), boxes(s), "name").select("collision_id", "name"),
        sql(within_sql("incidents", "boxes", "collision_id"), "incidents", boxes=boxes_sql()),
    ),
    "boroughs_filled": (
        lambda s, d: fill_place(raw_crashes(s, d), boxes(s), "borough").select("row_id", "borough"),
        sql(f"SELECT row_id, COALESCE(borough, name) AS borough FROM raw_crashes JOIN ({within_sql('raw_crashes', 'boxes', 'row_id')}) USING (row_id)", "raw_crashes", boxes=boxes_sql()),
    ),
    "nearest_polygon": (
        outside,
        sql(
            f"SELECT collision_id, arg_min(name, (round(m, 6), place)) AS borough_near, round(min(m), 2) AS metres FROM ({near_sql('incidents', 'boxes', 'collision_id')}) "
            f"JOIN (SELECT collision_id FROM ({within_sql('incidents', 'boxes', 'collision_id')}) WHERE name IS NULL) USING (collision_id) WHERE m <= 800 GROUP BY 1",
            "incidents", boxes=boxes_sql(),
        ),
    ),
    "located": (
        lambda s, d: locate(incidents(s, d), boxes(s), "name", 800.0).select("collision_id", "name"),
        sql(located_sql("incidents", "boxes", "collision_id", 800.0), "incidents", boxes=boxes_sql()),
    ),
    "places_finished": (
        finished,
        sql(
            f"SELECT row_id, b.name AS borough, z.name AS zip_code FROM ({located_sql('points', 'boxes', 'row_id', 800.0)}) b JOIN ({located_sql('points', 'zips', 'row_id', 800.0)}) z USING (row_id) "
            "WHERE b.name IS NOT NULL AND z.name IS NOT NULL",
            "raw_crashes", boxes=boxes_sql(), zips=ZIPS_SQL,
            points="SELECT * FROM raw_crashes WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0)",
        ),
    ),
    "crashes_cleaned": (
        whole_pipeline,
        sql(
            "SELECT p.collision_id, row_id, b.name AS borough, z.name AS zip_code, full_address, all_contributing_factors_str FROM points p "
            f"JOIN ({located_sql('points', 'boxes', 'row_id', 2000.0)}) b USING (row_id) JOIN ({located_sql('points', 'zips', 'row_id', 2000.0)}) z USING (row_id) "
            "WHERE b.name IS NOT NULL AND z.name IS NOT NULL",
            "raw_crashes", boxes=boxes_sql(), zips=ZIPS_SQL, named=FACTORS_BODY, **GEOCODE_STEPS,
            firsts=f"SELECT * FROM ({filled_sql('za')}) JOIN named USING (row_id) QUALIFY row_number() OVER (PARTITION BY collision_id ORDER BY row_id) = 1",
            points="SELECT * FROM firsts WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0)",
        ),
    ),
    "answers_materialised": (
        answer_sizes,
        sql(
            "SELECT question, COUNT(*) AS cells, CAST(SUM(cnt) AS BIGINT) AS cnt, CAST(SUM(injured) AS BIGINT) AS injured, CAST(SUM(fatalities) AS BIGINT) AS fatalities FROM ("
            + " UNION ALL ".join(
                f"SELECT '{q}' AS question, COUNT(*) AS cnt, SUM(i) AS injured, SUM(k) AS fatalities FROM facts GROUP BY {', '.join(dims)}"
                for q, dims in mat.DIMENSIONS.items()
            )
            + ") GROUP BY question",
            "merged",
            facts="SELECT COALESCE(NULLIF(lower(trim(replace(replace(safety_equipment, '[', ''), ']', ''))), ''), 'Unknown') AS safety, COALESCE(NULLIF(trim(person_injury), ''), 'Unknown') AS injury_or_blank, "
            "COALESCE(trim(person_injury), 'Unknown') AS injury, crash_datetime IS NOT NULL AS dated, hour(crash_datetime) AS hour, CASE WHEN isodow(crash_datetime) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
            f"{BAND} AS age_group, COALESCE(trim(person_sex), 'Unknown') AS sex, COALESCE(trim(person_type), 'Unknown') AS person_type_label, COALESCE(trim(ejection), 'Unknown') AS ejection_label, "
            "COALESCE(trim(position_in_vehicle), 'Unknown') AS position, CASE WHEN regexp_matches(lower(all_vehicle_types), 'motor|bike') THEN 'Motorcycle' WHEN regexp_matches(lower(all_vehicle_types), 'sedan|car|pass|auto') THEN 'Car' ELSE 'Other' END AS vtype, "
            "COALESCE(trim(borough), 'Unknown') AS borough_label, CASE WHEN person_injury IS NOT NULL AND lower(trim(person_injury)) NOT IN ('no injury', 'none', 'unknown', '') THEN 1 ELSE 0 END AS i, "
            "CASE WHEN regexp_matches(lower(COALESCE(person_injury, '')), 'kill|fatal') THEN 1 ELSE 0 END AS k FROM merged",
        ),
    ),
    "answer_from_table": (
        lambda s, d: materialised(s, d, "age_group_counts"),
        sql(f"SELECT {BAND} AS age_group, COUNT(*) AS cnt FROM merged GROUP BY 1", "merged"),
    ),
    "answer_live_when_filtered": (
        lambda s, d: materialised(s, d, "age_group_counts", Filters(boroughs=("Bronx",))),
        sql(f"SELECT {BAND} AS age_group, COUNT(*) AS cnt FROM merged WHERE borough = 'Bronx' GROUP BY 1", "merged"),
    ),
    "rewritten_by_year": (rewritten, sql("SELECT CAST(year(crash_datetime) AS INTEGER) AS year, borough, COUNT(*) AS cnt FROM incidents GROUP BY 1, 2", "incidents")),
    "rewrite_report": (rewrite_rows, sql("SELECT COUNT(*) AS rows FROM incidents", "incidents")),
    "csv_round_trip": (csv_round_trip, sql("SELECT person_injury, TRY_CAST(person_age AS DOUBLE) AS age, COUNT(*) AS cnt FROM persons GROUP BY 1, 2", "persons")),
    "facet_document": (
        facet_table,
        sql(" UNION ALL ".join([key_sql("boroughs", "borough"), key_sql("years", "year"), key_sql("vehicle_types", "vehicle_type"), key_sql("factors", "factor")]), "scored", summary=SUMMARY_SQL),
    ),
    "facets_loaded": (
        facets_loaded,
        sql(
            "SELECT DISTINCT 'boroughs' AS facet, borough AS value FROM summary UNION SELECT 'years', CAST(year AS VARCHAR) FROM summary UNION SELECT 'vehicle_types', vehicle_type FROM summary UNION SELECT 'factors', factor FROM summary",
            "scored", summary=SUMMARY_SQL,
        ),
    ),
    "summary_streamed": (
        summary_streamed,
        sql("SELECT borough, year, vehicle_type, factor, count, round(avg_severity, 6) AS avg_severity, sum_injured, sum_killed FROM summary", "scored", summary=SUMMARY_SQL),
    ),
    "coordinates_streamed": (coordinates_streamed, coordinates_sql(False)),
}
