"""Cleaning rules, integration and look-ups, on raw records derived from orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.functions import text as tx
from roadtally.functions.factors import FACTOR_LABELS, normalize_factor
from roadtally.functions.ids import is_single_digit, legacy_uuid
from roadtally.functions.streets import STREET_WORDS, build_address, clean_street
from roadtally.functions.tagging import (
    BOROUGH_WORDS, FACTOR_WORDS, FEMALE_WORDS, INJURY_WORDS, MALE_WORDS, PERSON_WORDS, VEHICLE_WORDS, tag_facets,
)
from roadtally.functions.temporal import combine_datetime
from roadtally.functions.vehicles import VEHICLE_PATTERNS, classify_vehicle, vehicle_class
from roadtally.operators.joins import fill_from
from roadtally.operators.windows import dedupe_first, dense_row_number, fill_within
from roadtally.plans import crashes as cr
from roadtally.plans import persons as pe
from roadtally.plans.integration import merge
from roadtally.registry.places import rounded
from roadtally.registry.tables import incidents, labels_sql, persons, raw_crashes, raw_persons, sql, table


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(lit(v) for v in values)


def mapped_sql(c: str, mapping: dict[str, str], default: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


def factor_sql(c: str) -> str:
    return mapped_sql(f"lower(trim({c}))", FACTOR_LABELS, f"lower(trim({c}))")


def vehicle_sql(c: str) -> str:
    tests = " ".join(f"WHEN regexp_matches(lower({c}), {lit(p)}) THEN {lit(n)}" for n, p in VEHICLE_PATTERNS.items())
    return f"CASE {tests} ELSE 'Other' END"


def street_sql(c: str) -> str:
    out = f"trim(regexp_replace(replace(replace(upper({c}), '.', ''), '-', ' '), '\\s+', ' ', 'g'))"
    for short, full in STREET_WORDS.items():
        out = f"replace({out}, ' {short} ', ' {full} ')"
    return out


ADDRESS_SQL = (
    "CASE WHEN COALESCE(NULLIF(a, ''), NULLIF(b, ''), NULLIF(c, '')) IS NOT NULL THEN "
    "concat_ws(', ', NULLIF(a, ''), 'AND ' || NULLIF(b, ''), NULLIF(c, '')) || ', New York, NY' END"
)
DATETIME_SQL = "strftime(try_strptime(crash_date || ' ' || crash_time, '%m/%d/%Y %-H:%M'), '%Y-%m-%d %H:%M:%S')"
UUID_SQL = (
    "CASE WHEN regexp_full_match(person_id, '[0-9]{7}') THEN concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), "
    "substr('89ab', CAST(('0x' || substr(h, 17, 1))::INTEGER % 4 + 1 AS INTEGER), 1) || substr(h, 18, 3), substr(h, 21, 12)) ELSE person_id END"
)
HASHED = "SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(person_id)) AS h FROM raw_persons"


def clean_factor_table(s, d):
    return cr.clean_factors(raw_crashes(s, d)).select("row_id", "factor_1", "factor_2", "factor_3", "all_contributing_factors_str")


FACTORS_BODY = (
    "SELECT row_id, COALESCE(f1, 'unspecified') AS factor_1, COALESCE(f2, 'unspecified') AS factor_2, COALESCE(f3, 'unspecified') AS factor_3, "
    "COALESCE(NULLIF(array_to_string(list_filter([f1, f2, f3], lambda f: f IS NOT NULL AND f <> 'unspecified'), ', '), ''), 'none') AS all_contributing_factors_str "
    "FROM (SELECT row_id, " + ", ".join(f"{factor_sql(f'factor_{i}')} AS f{i}" for i in (1, 2, 3)) + " FROM raw_crashes) "
    "WHERE NOT (COALESCE(f1, 'unspecified') = 'unspecified' AND COALESCE(f2, 'unspecified') = 'unspecified' AND COALESCE(f3, 'unspecified') = 'unspecified')"
)
FACTORS_SQL = sql(FACTORS_BODY, "raw_crashes")

# Person rules as a chain of SQL steps; each step reads the one before.
OCC, PED, BIC, MOT = lit(pe.OCCUPANT), lit(pe.PEDESTRIAN), lit(pe.BICYCLIST), lit(pe.OTHER_MOTORIZED)


def position_case(*rules: str) -> str:
    return "CASE " + " ".join(rules) + " ELSE position_in_vehicle END AS position_in_vehicle"


YOUNG_SQL = position_case(
    f"WHEN person_type = {OCC} AND person_age < 3 AND position_in_vehicle IN ({listed(pe.UNLIKELY_INFANT)}) THEN 'Unknown'",
    f"WHEN person_type = {OCC} AND person_age < 12 AND position_in_vehicle = 'Driver' THEN 'Unknown'",
    f"WHEN person_type = {BIC} AND person_age < 3 AND position_in_vehicle = 'Driver' THEN 'Unknown'",
)
TYPE_SQL = position_case(
    f"WHEN person_type = {PED} THEN 'Does Not Apply'",
    f"WHEN person_type = {BIC} AND position_in_vehicle IN ({listed(pe.UNLIKELY_BICYCLIST)}) THEN 'Does Not Apply'",
    f"WHEN person_type = {OCC} AND position_in_vehicle IN ({listed(pe.UNLIKELY_OCCUPANT)}) THEN 'Unknown'",
    f"WHEN person_type = {MOT} AND position_in_vehicle IN ({listed(pe.UNLIKELY_MOTORIZED)}) THEN 'Unknown'",
)
PED_SQL = ", ".join(f"CASE WHEN person_type = {PED} THEN {c} ELSE 'Does Not Apply' END AS {c}" for c in pe.PED_COLUMNS)
EJECTION_STEPS = {
    "e1": "SELECT * REPLACE (CASE WHEN person_type IN ('Bicyclist', 'Other Motorized', 'Pedestrian') THEN 'Does Not Apply' "
    "WHEN person_type = 'Occupant' AND ejection = 'Does Not Apply' THEN 'Unknown' ELSE ejection END AS ejection) FROM {src}",
    "e2": "SELECT * REPLACE (CASE WHEN ejection = 'Ejected' AND person_injury IS DISTINCT FROM 'Killed' THEN 'Injured' ELSE person_injury END AS person_injury) FROM e1",
    "e3": "SELECT * REPLACE (CASE WHEN person_injury = 'Killed' THEN 'Apparent Death' ELSE emotional_status END AS emotional_status) FROM e2",
    "e4": "SELECT * REPLACE (CASE WHEN ejection = 'Ejected' AND bodily_injury = 'Head' AND emotional_status = 'Unconscious' THEN 'Killed' ELSE person_injury END AS person_injury) FROM e3",
}


def ejection_steps(src: str) -> dict[str, str]:
    return {k: v.replace("{src}", src) for k, v in EJECTION_STEPS.items()}


def complaint_steps(src: str) -> dict[str, str]:
    return {
        "modes": f"SELECT bodily_injury, complaint AS mode FROM (SELECT *, row_number() OVER (PARTITION BY bodily_injury ORDER BY n DESC, complaint) AS r FROM "
        f"(SELECT bodily_injury, complaint, COUNT(*) AS n FROM {src} WHERE bodily_injury IS NOT NULL AND complaint IS NOT NULL GROUP BY 1, 2)) WHERE r = 1",
        "complained": f"SELECT p.* REPLACE (CASE WHEN complaint IS NULL OR complaint IN ('Does Not Apply', 'Unknown') THEN "
        f"CASE WHEN p.bodily_injury IS NULL THEN 'Unknown' ELSE mode END ELSE complaint END AS complaint) FROM {src} p LEFT JOIN modes m ON p.bodily_injury = m.bodily_injury",
    }


EQUIPMENT_SQL = (
    "SELECT * REPLACE (CASE WHEN ped_role = 'Pedestrian' THEN 'Unknown' WHEN ped_role = 'In-Line Skater' AND safety_equipment IN ('Lap Belt & Harness', 'Lap Belt') "
    "THEN 'Unknown' ELSE safety_equipment END AS safety_equipment) FROM {src}"
)
PIPELINE = {
    "hashed": HASHED,
    "p1": f"SELECT * EXCLUDE (h, crash_date, crash_time) REPLACE ({UUID_SQL} AS person_id), strftime(try_strptime(crash_date || ' ' || crash_time, '%m/%d/%Y %-H:%M'), '%Y-%m-%d %H:%M:%S') AS crash_datetime FROM hashed "
    "WHERE try_strptime(crash_date, '%m/%d/%Y') <= TIMESTAMP '2026-01-01' AND NOT COALESCE(regexp_full_match(person_id, '[0-9]'), FALSE) AND vehicle_id IS NOT NULL",
    "p2": "SELECT * EXCLUDE (contributing_factor_1, contributing_factor_2) REPLACE (COALESCE(person_sex, 'U') AS person_sex, "
    "CASE WHEN person_age > 0 AND person_age < 120 THEN person_age ELSE (SELECT AVG(person_age) FROM p1 WHERE person_age > 0 AND person_age < 120) END AS person_age) FROM p1",
    "p3": f"SELECT * REPLACE ({YOUNG_SQL}) FROM p2",
    "p4": f"SELECT * REPLACE ({PED_SQL}) FROM p3",
    "p5": f"SELECT * EXCLUDE (ped_action, ped_location) REPLACE ({TYPE_SQL}) FROM p4 WHERE ped_location IS NOT NULL OR ped_action IS NOT NULL OR ped_role IS NOT NULL",
    "p6": "SELECT * FROM p5 WHERE COALESCE(ejection, emotional_status, bodily_injury, complaint, position_in_vehicle, safety_equipment) IS NOT NULL",
    **complaint_steps("p6"),
    **ejection_steps("complained"),
    "p7": EQUIPMENT_SQL.replace("{src}", "e4"),
}
STANDARD = ["person_type", "person_injury", "person_sex", "ped_role", "ejection", "emotional_status", "bodily_injury", "position_in_vehicle", "safety_equipment", "complaint"]
PIPELINE_SQL = sql(
    "SELECT DISTINCT unique_id, collision_id, person_id, vehicle_id, round(person_age, 6) AS person_age, crash_datetime, "
    + ", ".join(f"COALESCE(NULLIF(lower(trim({c})), 'nan'), 'unknown') AS {c}" for c in STANDARD) + " FROM p7",
    "raw_persons", **PIPELINE,
)


def cleaned_persons(s, d):
    out = pe.clean_persons(raw_persons(s, d), as_of="2026-01-01")
    return rounded(out, "person_age").withColumn("crash_datetime", F.date_format("crash_datetime", "yyyy-MM-dd HH:mm:ss"))


def geocodes(s, d):
    """A lookup with its own gaps, by collision, by row and by address."""
    orders = table(s, d, "orders")
    return orders.selectExpr(
        "o_orderkey AS batch",
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS orig_index",
        "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey - o_orderkey % 20 % 2 AS STRING) END AS collision_id",
        "CASE o_orderkey % 5 WHEN 0 THEN ' 5 avenue n, new york, ny' WHEN 1 THEN 'BED STUY ROAD X, New York, NY' END AS full_address",
        "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS latitude_geocode",
        "CASE WHEN o_orderkey % 11 <> 0 THEN CAST(-o_orderkey AS DOUBLE) END AS longitude_geocode",
    )


GEOCODES_SQL = (
    "SELECT o_orderkey AS batch, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS orig_index, "
    "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey - o_orderkey % 20 % 2 AS VARCHAR) END AS collision_id, "
    "CASE o_orderkey % 5 WHEN 0 THEN ' 5 avenue n, new york, ny' WHEN 1 THEN 'BED STUY ROAD X, New York, NY' END AS full_address, "
    "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS latitude_geocode, "
    "CASE WHEN o_orderkey % 11 <> 0 THEN CAST(-o_orderkey AS DOUBLE) END AS longitude_geocode FROM orders"
)


def coordinates_filled(s, d, later_wins=False):
    crashes = cr.clean_streets(raw_crashes(s, d))
    filled = cr.fill_coordinates(crashes, geocodes(s, d), "batch", row_id="row_id", later_wins=later_wins)
    return filled.select("row_id", "latitude", "longitude")


def first_geocodes_sql(key: str) -> str:
    return (
        f"SELECT {key} AS k, arg_min(latitude_geocode, batch) FILTER (WHERE latitude_geocode IS NOT NULL) AS lat, "
        f"arg_min(longitude_geocode, batch) FILTER (WHERE longitude_geocode IS NOT NULL) AS lon FROM geocodes WHERE {key} IS NOT NULL GROUP BY 1"
    )


GEOCODE_STEPS = {
    "geocodes": GEOCODES_SQL,
    "addressed": f"SELECT row_id, collision_id, latitude, longitude, {ADDRESS_SQL} AS full_address FROM (SELECT *, {street_sql('on_street_name')} AS a, "
    f"{street_sql('cross_street_name')} AS b, {street_sql('off_street_name')} AS c FROM raw_crashes)",
    "by_row": first_geocodes_sql("orig_index"),
    "by_id": first_geocodes_sql("collision_id"),
    "by_address": first_geocodes_sql("upper(trim(full_address))"),
}


def filled_sql(order: str) -> str:
    """Coordinates by row (i), collision (z) and address (a), the first of `order` first."""
    lat, lon = (", ".join(f"{t}.{c}" for t in order) for c in ("lat", "lon"))
    return (
        f"SELECT row_id, collision_id, full_address, COALESCE(latitude, {lat}) AS latitude, COALESCE(longitude, {lon}) AS longitude "
        "FROM addressed c LEFT JOIN by_row i ON c.row_id = i.k LEFT JOIN by_id z ON CAST(c.collision_id AS VARCHAR) = z.k LEFT JOIN by_address a ON upper(trim(c.full_address)) = a.k"
    )


def coordinates_sql(later_wins: bool) -> str:
    return sql(f"SELECT row_id, latitude, longitude FROM ({filled_sql('azi' if later_wins else 'iza')})", "raw_crashes", **GEOCODE_STEPS)


MERGED_SQL = sql(
    "SELECT unique_id, collision_id, "
    + ", ".join(
        f"COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY collision_id ORDER BY unique_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER (PARTITION BY collision_id ORDER BY unique_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in ("borough", "latitude", "longitude")
    )
    + ", strftime(COALESCE(crash_datetime, person_datetime), '%Y-%m-%d %H:%M:%S') AS crash_datetime, "
    + mapped_sql("lower(trim(position_in_vehicle))", {k.lower(): v for k, v in pe.POSITION_LABELS.items()}, "'OTHER'")
    + " AS position_in_vehicle_clean FROM merged WHERE borough IS NOT NULL OR latitude IS NOT NULL OR longitude IS NOT NULL",
    "merged",
)


def merged_table(s, d):
    people = persons(s, d).withColumnRenamed("person_datetime", "crash_datetime")
    out = merge(people, incidents(s, d))
    return out.select(
        "unique_id", "collision_id", "borough", "latitude", "longitude",
        F.date_format("crash_datetime", "yyyy-MM-dd HH:mm:ss").alias("crash_datetime"), "position_in_vehicle_clean",
    )


def filled_within(s, d):
    return fill_within(persons(s, d), "person_type", ["safety_equipment", "ejection"], ["unique_id"]).select("unique_id", "person_type", "safety_equipment", "ejection")


FILLED_SQL = sql(
    "SELECT unique_id, person_type, "
    + ", ".join(
        f"COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY person_type ORDER BY unique_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER (PARTITION BY person_type ORDER BY unique_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in ("safety_equipment", "ejection")
    )
    + " FROM persons",
    "persons",
)


def hits_sql(words: dict[str, str]) -> str:
    tests = ", ".join(f"CASE WHEN contains(t, {lit(w)}) THEN {lit(v)} END" for w, v in words.items())
    return f"NULLIF(array_to_string(list_sort(list_distinct([{tests}])), '|'), '')"


def any_sql(words) -> str:
    return " OR ".join(f"contains(t, {lit(w)})" for w in words)


GENDER_SQL = (
    "CASE WHEN contains(' ' || t || ' ', ' f ') THEN 'F' WHEN contains(' ' || t || ' ', ' m ') THEN 'M' "
    f"WHEN {any_sql(FEMALE_WORDS)} THEN 'F' WHEN {any_sql(MALE_WORDS)} THEN 'M' END"
)


def tagged(s, d, name, key):
    out = tag_facets(table(s, d, name), "text")
    listed_cols = ["tag_vehicles", "tag_person_types", "tag_injuries", "tag_factors"]
    joined = {c: F.nullif(F.array_join(F.array_sort(c), "|"), F.lit("")) for c in listed_cols}
    return out.withColumns(joined).select(*key, "year_from", "year_to", "tag_borough", "tag_gender", *listed_cols)


def tagged_sql(name: str, key: list[str]) -> str:
    years = "list_sort(list_transform(regexp_extract_all(t, '\\b(20\\d{2})\\b', 1), lambda y: CAST(y AS INTEGER)))"
    borough = "CASE " + " ".join(f"WHEN contains(t, {lit(w)}) THEN {lit(v)}" for w, v in BOROUGH_WORDS.items()) + " END"
    return (
        f"SELECT {', '.join(key)}, {years}[1] AS year_from, {years}[-1] AS year_to, {borough} AS tag_borough, {GENDER_SQL} AS tag_gender, "
        f"{hits_sql(VEHICLE_WORDS)} AS tag_vehicles, {hits_sql(PERSON_WORDS)} AS tag_person_types, {hits_sql(INJURY_WORDS)} AS tag_injuries, {hits_sql(FACTOR_WORDS)} AS tag_factors "
        f"FROM (SELECT *, lower(trim(COALESCE(text, ''))) AS t FROM {name})"
    )


QUERIES = {
    "factors_cleaned": (clean_factor_table, FACTORS_SQL),
    "factor_normalised": (
        lambda s, d: raw_crashes(s, d).select("row_id", normalize_factor("factor_1").alias("factor")),
        sql(f"SELECT row_id, {factor_sql('factor_1')} AS factor FROM raw_crashes", "raw_crashes"),
    ),
    "vehicles_classified": (
        lambda s, d: raw_crashes(s, d).select("row_id", classify_vehicle("vehicle_1").alias("a"), classify_vehicle("vehicle_2").alias("b"), vehicle_class("vehicle_1").alias("c")),
        sql(
            f"SELECT row_id, {vehicle_sql('vehicle_1')} AS a, {vehicle_sql('vehicle_2')} AS b, CASE WHEN regexp_matches(lower(vehicle_1), 'motor|bike') THEN 'Motorcycle' "
            "WHEN regexp_matches(lower(vehicle_1), 'sedan|car|pass|auto') THEN 'Car' ELSE 'Other' END AS c FROM raw_crashes",
            "raw_crashes",
        ),
    ),
    "vehicle_lists": (
        lambda s, d: cr.clean_vehicles(raw_crashes(s, d)).select("row_id", F.array_join("all_vehicle_types", "|").alias("types")),
        sql(
            f"SELECT row_id, array_to_string(CASE WHEN a IS NULL AND b IS NULL THEN [] WHEN a IS NULL THEN [b] WHEN b IS NULL OR a = b THEN [a] ELSE [a, b] END, '|') AS types FROM "
            f"(SELECT row_id, CASE WHEN vehicle_1 IS NOT NULL THEN {vehicle_sql('vehicle_1')} END AS a, CASE WHEN vehicle_2 IS NOT NULL THEN {vehicle_sql('vehicle_2')} END AS b FROM raw_crashes)",
            "raw_crashes",
        ),
    ),
    "streets_cleaned": (
        lambda s, d: raw_crashes(s, d).select("row_id", *[clean_street(c).alias(c) for c in cr.STREETS]),
        sql("SELECT row_id, " + ", ".join(f"{street_sql(c)} AS {c}" for c in cr.STREETS) + " FROM raw_crashes", "raw_crashes"),
    ),
    "addresses_built": (
        lambda s, d: raw_crashes(s, d).select("row_id", build_address(*[clean_street(c) for c in cr.STREETS]).alias("full_address")),
        sql(f"SELECT row_id, {ADDRESS_SQL} AS full_address FROM (SELECT row_id, {street_sql('on_street_name')} AS a, {street_sql('cross_street_name')} AS b, {street_sql('off_street_name')} AS c FROM raw_crashes)", "raw_crashes"),
    ),
    "datetimes_combined": (
        lambda s, d: raw_crashes(s, d).select("row_id", F.date_format(combine_datetime("crash_date", "crash_time"), "yyyy-MM-dd HH:mm:ss").alias("crash_datetime")),
        sql(f"SELECT row_id, {DATETIME_SQL} AS crash_datetime FROM raw_crashes", "raw_crashes"),
    ),
    "boroughs_normalised": (
        lambda s, d: incidents(s, d).select("collision_id", tx.normalize_borough("borough").alias("borough")),
        sql("SELECT collision_id, COALESCE(array_to_string(list_transform(string_split(lower(trim(borough)), ' '), lambda w: upper(w[1]) || w[2:]), ' '), 'Unknown') AS borough FROM incidents", "incidents"),
    ),
    "labels_cleaned": (
        lambda s, d: incidents(s, d).select("collision_id", tx.clean_label("all_contributing_factors").alias("label"), tx.clean_list("all_vehicle_types").alias("list")),
        sql(
            "SELECT collision_id, trim(regexp_replace(regexp_replace(regexp_replace(all_contributing_factors, '[\\[\\](){}<>]', '', 'g'), '[^\\w\\s\\-/,&]', '', 'g'), '\\s+', ' ', 'g')) AS label, "
            "array_to_string(list_filter(list_transform(string_split(all_vehicle_types, ','), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '[\\[\\](){}<>]', '', 'g'), '[^\\w\\s\\-/,&]', '', 'g'), '\\s+', ' ', 'g'))), lambda x: x <> ''), ',') AS list FROM incidents",
            "incidents",
        ),
    ),
    "lists_parsed": (
        lambda s, d: incidents(s, d).select("collision_id", F.array_join(tx.or_unknown(tx.parse_list("all_vehicle_types")), "|").alias("vehicles"), F.array_join(tx.parse_list("all_contributing_factors"), "|").alias("factors")),
        sql(f"SELECT collision_id, array_to_string({labels_sql('all_vehicle_types')}, '|') AS vehicles, array_to_string({labels_sql('all_contributing_factors', False)}, '|') AS factors FROM incidents", "incidents"),
    ),
    "legacy_ids": (
        lambda s, d: raw_persons(s, d).where(~is_single_digit("person_id")).select("unique_id", legacy_uuid("person_id").alias("person_id")),
        sql(f"SELECT unique_id, {UUID_SQL} AS person_id FROM hashed WHERE NOT COALESCE(regexp_full_match(person_id, '[0-9]'), FALSE)", "raw_persons", hashed=HASHED),
    ),
    "positions_fixed": (
        lambda s, d: pe.fix_positions(raw_persons(s, d)).select("unique_id", "position_in_vehicle"),
        sql("SELECT unique_id, position_in_vehicle FROM typed", "raw_persons", young=f"SELECT * REPLACE ({YOUNG_SQL}) FROM raw_persons", typed=f"SELECT * REPLACE ({TYPE_SQL}) FROM young"),
    ),
    "pedestrians_fixed": (
        lambda s, d: pe.fix_pedestrian(raw_persons(s, d), drop_details=False).select("unique_id", *pe.PED_COLUMNS),
        sql("SELECT * FROM ped WHERE ped_location IS NOT NULL OR ped_action IS NOT NULL OR ped_role IS NOT NULL", "raw_persons", ped=f"SELECT unique_id, {PED_SQL} FROM raw_persons"),
    ),
    "ejections_fixed": (
        lambda s, d: pe.fix_ejection(raw_persons(s, d)).select("unique_id", "ejection", "person_injury", "emotional_status"),
        sql("SELECT unique_id, ejection, person_injury, emotional_status FROM e4", "raw_persons", **ejection_steps("raw_persons")),
    ),
    "equipment_fixed": (
        lambda s, d: pe.fix_equipment(raw_persons(s, d)).select("unique_id", "safety_equipment", "position_in_vehicle"),
        sql("SELECT unique_id, safety_equipment, position_in_vehicle FROM fixed", "raw_persons", fixed=EQUIPMENT_SQL.replace("{src}", "raw_persons")),
    ),
    "complaints_filled": (
        lambda s, d: pe.fill_complaint(raw_persons(s, d)).select("unique_id", "complaint"),
        sql("SELECT unique_id, complaint FROM complained", "raw_persons", **complaint_steps("raw_persons")),
    ),
    "positions_labelled": (
        lambda s, d: raw_persons(s, d).select("unique_id", pe.clean_position("position_in_vehicle").alias("position")),
        sql("SELECT unique_id, " + mapped_sql("lower(trim(position_in_vehicle))", {k.lower(): v for k, v in pe.POSITION_LABELS.items()}, "'OTHER'") + " AS position FROM raw_persons", "raw_persons"),
    ),
    "persons_cleaned": (cleaned_persons, PIPELINE_SQL),
    "persons_integrated": (merged_table, MERGED_SQL),
    "filled_within_type": (filled_within, FILLED_SQL),
    "first_row_per_collision": (
        lambda s, d: dedupe_first(raw_crashes(s, d), ["collision_id"], ["row_id"]).select("collision_id", "row_id"),
        sql("SELECT collision_id, MIN(row_id) AS row_id FROM raw_crashes GROUP BY 1", "raw_crashes"),
    ),
    "row_numbers": (
        lambda s, d: dense_row_number(table(s, d, "events"), ["ts", "event_id"], "row_number").select("event_id", "row_number"),
        "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_number FROM events",
    ),
    "coordinates_filled": (coordinates_filled, coordinates_sql(False)),
    "coordinates_filled_later_wins": (lambda s, d: coordinates_filled(s, d, True), coordinates_sql(True)),
    "boroughs_filled_from_crashes": (
        lambda s, d: fill_from(raw_crashes(s, d).withColumn("collision_id", F.col("row_id")), incidents(s, d).select("collision_id", "borough"), "collision_id", ["borough"]).select("row_id", "borough"),
        sql("SELECT row_id, COALESCE(r.borough, i.borough) AS borough FROM raw_crashes r LEFT JOIN incidents i ON r.row_id = i.collision_id", "raw_crashes", "incidents"),
    ),
    "documents_tagged": (lambda s, d: tagged(s, d, "documents", ["doc_id"]), tagged_sql("documents", ["doc_id"])),
    "conversations_tagged": (lambda s, d: tagged(s, d, "conversations", ["conv_id", "turn"]), tagged_sql("conversations", ["conv_id", "turn"])),
}
