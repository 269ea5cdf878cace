"""What is stored and used again: cubes, sums under corrections, sketches, samples by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.operators import sketches
from roadtally.operators.filters import Filters, sample
from roadtally.operators.columns import with_totals
from roadtally.plans import cube
from roadtally.plans.derive import explode_cells, with_basics
from roadtally.plans.pyramid import build_pyramid, map_cells
from roadtally.plans.textindex import build_index, search_indexed
from roadtally.registry.people import AGE, BAND, CHOSEN, CHOSEN_SQL, INJURED, SAFETY, by_injury, label_sql
from roadtally.registry.places import SUMMARY_SQL, rounded
from roadtally.registry.tables import incidents, merged, persons, sql, table
from roadtally.session import scratch_dir
from roadtally.streaming.corrections import corrected_summary, merge_batch

PLACED = Filters(boroughs=("Bronx", "Manhattan"), years=(1993, 1996))
PLACED_SQL = "borough IN ('Bronx', 'Manhattan') AND year(crash_datetime) BETWEEN 1993 AND 1996"
TYPED = Filters(person_types=("occupant",), injuries=("Killed", "Injured"))
TYPED_SQL = "lower(COALESCE(person_type, '')) IN ('occupant') AND person_injury IN ('Killed', 'Injured')"


def cubed(s, d, name, filters):
    folder = scratch_dir(s, "cube")
    table = merged(s, d)
    cube.build_cubes(table, folder)
    return cube.answer(s, name, table, folder, filters)


def cube_sizes(s, d):
    folder = scratch_dir(s, "cube")
    cube.build_cubes(merged(s, d), folder)
    return cube.stored_rows(s, folder).groupBy("grain", "question").agg(F.sum("cnt").alias("cnt"))


def corrected(s, d):
    """Three batches: all crashes, corrections and deletions of some, late rows that are older than what is stored; the second comes twice."""
    folder, rows = scratch_dir(s, "corrected"), incidents(s, d)
    moved = F.when(F.col("collision_id") % 7 == 0, F.lit("Bronx")).otherwise(F.col("borough"))
    first = rows.withColumns({"version": F.lit(1), "deleted": F.lit(False)})
    second = rows.where("collision_id % 7 = 0 or collision_id % 11 = 0").withColumns(
        {"borough": moved, "persons_killed": F.lit("1"), "version": F.lit(3), "deleted": F.col("collision_id") % 11 == 0})
    late = rows.where("collision_id % 5 = 0").withColumns({"borough": F.lit("Late"), "version": F.when(F.col("collision_id") % 2 == 0, 2).otherwise(0), "deleted": F.lit(False)})
    for batch_id, batch in ((0, first), (1, second), (2, late), (1, second)):
        merge_batch(batch, batch_id, folder, "collision_id", "version", "deleted")
    return rounded(corrected_summary(s, folder), "avg_severity")


CORRECTED_SQL = (
    "SELECT * REPLACE (COALESCE(TRY_CAST(persons_killed AS BIGINT), 0) AS total_killed, "
    "total_injured + 5 * COALESCE(TRY_CAST(persons_killed AS BIGINT), 0) AS severity_score) FROM ("
    "SELECT * REPLACE (CASE WHEN collision_id % 7 = 0 THEN 'Bronx' WHEN collision_id % 10 = 0 THEN 'Late' ELSE borough END AS borough, "
    "CASE WHEN collision_id % 7 = 0 THEN '1' ELSE persons_killed END AS persons_killed) FROM scored WHERE collision_id % 11 <> 0)"
)


def about(s, d, rolled):
    """Exact counts, and whether the sketches' estimates are within three standard errors (or one) of them."""
    rows = incidents(s, d)
    if rolled == "cells":
        found = sketches.distinct_crashes(sketches.summary_sketches(rows), ["vehicle_type"])
        exploded = explode_cells(with_basics(rows), "known", ["collision_id"])
        exact = exploded.groupBy("vehicle_type").agg(F.countDistinct("collision_id").alias("crashes"))
        both = exact.join(found.withColumnRenamed("crashes_about", "about"), "vehicle_type")
        return both.select("vehicle_type", "crashes", (F.abs(F.col("about") - F.col("crashes")) <= F.greatest(F.lit(1), F.col("crashes") * 0.05)).alias("near"))
    stored = sketches.distinct_sketches(persons(s, d).withColumn("hour", F.hour("person_datetime")), "collision_id", ["person_type", "hour"])
    found = sketches.estimated(sketches.rolled_up(stored, ["person_type"]), "about")
    exact = persons(s, d).groupBy("person_type").agg(F.countDistinct("collision_id").alias("crashes"))
    both = exact.join(found, "person_type")
    return both.select("person_type", "crashes", (F.abs(F.col("about") - F.col("crashes")) <= F.greatest(F.lit(1), F.col("crashes") * 0.05)).alias("near"))


def searched(s, d, name, key, query, cols, year_col=None):
    folder, rows = scratch_dir(s, "grams"), table(s, d, name)
    build_index(rows, key, cols, folder, year_col)
    return search_indexed(rows, folder, query, key, cols, year_col)


def mapped(s, d, level, box=None):
    folder = scratch_dir(s, "pyramid")
    build_pyramid(with_totals(incidents(s, d), "persons"), folder)
    cells = map_cells(s, folder, level, box)
    return cells.select(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "n", "severity", F.round("severity_mean", 6).alias("severity_mean"))


def mapped_sql(level: int, where: str = "TRUE") -> str:
    scale = f"CAST({1 << level} AS DOUBLE)"
    return sql(
        f"SELECT round((y + 0.5::DOUBLE) * (180 / {scale}) - 90, 9) AS lat, round((x + 0.5::DOUBLE) * (360 / {scale}) - 180, 9) AS lon, n, severity, "
        "round(severity / n, 6) AS severity_mean FROM (SELECT x, y, COUNT(*) AS n, CAST(SUM(severity_score) AS DOUBLE) AS severity FROM ("
        f"SELECT floor((longitude + 180) / 360 * {scale}) AS x, floor((latitude + 90) / 180 * {scale}) AS y, severity_score FROM scored WHERE latitude IS NOT NULL "
        f"AND longitude IS NOT NULL) WHERE {where} GROUP BY x, y)",
        "scored",
    )


_KEPT = "CAST('0x' || md5('42|' || CAST(unique_id AS VARCHAR))[:12] AS BIGINT) < CAST(floor({share} * 281474976710656) AS BIGINT)"

QUERIES = {
    "cube_age_groups": (
        lambda s, d: cubed(s, d, "age_group_counts", CHOSEN),
        sql(f"SELECT {BAND} AS age_group, COUNT(*) AS cnt FROM merged WHERE {CHOSEN_SQL} GROUP BY 1", "merged"),
    ),
    "cube_injuries_by_hour": (
        lambda s, d: cubed(s, d, "injuries_by_hour", PLACED),
        by_injury("CAST(hour(crash_datetime) AS INTEGER)", "hour", "", f"crash_datetime IS NOT NULL AND {PLACED_SQL}"),
    ),
    "cube_safety": (lambda s, d: cubed(s, d, "safety_vs_injury", TYPED), by_injury(SAFETY, "safety", "", TYPED_SQL, " ORDER BY cnt DESC, safety, injury LIMIT 1000")),
    "cube_injury_rates": (
        lambda s, d: rounded(cubed(s, d, "person_type_injury_rates", Filters(min_age=20, max_age=40, boroughs=("Bronx",))), "rate"),
        sql(
            f"SELECT {label_sql('person_type')} AS person_type_label, COUNT(*) FILTER (WHERE {INJURED}) AS injured, COUNT(*) AS total, "
            f"round(COUNT(*) FILTER (WHERE {INJURED}) / COUNT(*), 6) AS rate FROM merged WHERE {AGE} BETWEEN 20 AND 40 AND borough = 'Bronx' GROUP BY 1",
            "merged",
        ),
    ),
    "cube_sizes": (
        cube_sizes,
        sql(
            "SELECT grain, question, (SELECT COUNT(*) FROM merged) AS cnt FROM (SELECT unnest([" + ", ".join(f"'{g}'" for g in cube.GRAINS) + "]) AS grain), "
            "(SELECT unnest([" + ", ".join(f"'{q}'" for q in cube.DIMENSIONS) + "]) AS question)",
            "merged",
        ),
    ),
    "summary_corrected": (
        corrected,
        sql(
            "SELECT borough, year, vehicle_type, factor, count, round(avg_severity, 6) AS avg_severity, sum_injured, sum_killed FROM summary", "scored",
            corrected=CORRECTED_SQL, summary=SUMMARY_SQL.replace("FROM scored", "FROM corrected"),
        ),
    ),
    "distinct_crashes_rolled_up": (
        lambda s, d: about(s, d, "hours"),
        sql("SELECT person_type, COUNT(DISTINCT collision_id) AS crashes, TRUE AS near FROM persons GROUP BY 1", "persons"),
    ),
    "distinct_crashes_of_cells": (
        lambda s, d: about(s, d, "cells"),
        sql("SELECT vehicle_type, COUNT(DISTINCT collision_id) AS crashes, TRUE AS near FROM exploded GROUP BY 1", "scored",
            exploded="SELECT collision_id, v AS vehicle_type FROM (" + SUMMARY_SQL.split("FROM (", 1)[1].removesuffix(" GROUP BY ALL")),
    ),
    "search_indexed_parts": (
        lambda s, d: searched(s, d, "part", "p_partkey", "Blue", ["p_name", "p_type"], "p_size").select("p_partkey", "p_name", "p_type", "p_size"),
        "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE contains(lower(p_name), 'blue') OR contains(lower(p_type), 'blue') OR contains(CAST(p_size AS VARCHAR), 'blue')",
    ),
    "search_indexed_documents": (
        lambda s, d: searched(s, d, "documents", "doc_id", "the thon", ["text", "lang"]).select("doc_id"),
        "SELECT doc_id FROM documents WHERE COALESCE(contains(lower(text), 'the thon'), FALSE) OR COALESCE(contains(lower(lang), 'the thon'), FALSE)",
    ),
    "map_cells_fine": (lambda s, d: mapped(s, d, 17), mapped_sql(17)),
    "map_cells_of_box": (
        lambda s, d: mapped(s, d, 13, (-74.1, 40.6, -73.9, 40.75)),
        mapped_sql(13, "x BETWEEN floor((-74.1 + 180) / 360 * 8192) AND floor((-73.9 + 180) / 360 * 8192) AND y BETWEEN floor((40.6 + 90) / 180 * 8192) AND floor((40.75 + 90) / 180 * 8192)"),
    ),
    "sample_by_key": (
        lambda s, d: sample(persons(s, d), 0.25, key=["unique_id"]).select("unique_id", "person_type"),
        sql(f"SELECT unique_id, person_type FROM persons WHERE {_KEPT.format(share=0.25)}", "persons"),
    ),
}
