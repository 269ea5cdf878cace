"""Filters, sources and sinks: tables that are written out, read back and narrowed down."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from roadtally.functions.factors import factor_labels, normalize_factor
from roadtally.functions.numbers import jitter, to_int0
from roadtally.functions.streets import fallback_address
from roadtally.functions.text import contains_ci, parse_list, unique_labels
from roadtally.operators import filters as flt
from roadtally.operators.aggregates import count_by
from roadtally.operators.columns import with_totals
from roadtally.operators.spatial import point_in_polygon
from roadtally.operators.stats import hotspots
from roadtally.plans.derive import build_facets, build_summary
from roadtally.registry.cleaning import geocodes
from roadtally.registry.derived import boxes_sql, within_sql
from roadtally.registry.places import SUMMARY_SQL, rounded
from roadtally.registry.tables import BOXES, incidents, labels_sql, raw_crashes, sql, table
from roadtally.session import scratch_dir
from roadtally.sources import facets as fc
from roadtally.sources.readers import first_source, read_batches, read_csv, read_parquet, read_polygons
from roadtally.sources.writers import export, write_csv, write_table
from roadtally.streaming.summary import read_summary, stream_summary

PARTIES = {"pedestrians": 3, "cyclist": 5, "motorist": 7}


def filtered(test):
    """Crashes that pass a test; the test is made when a session exists."""
    return lambda s, d: incidents(s, d).where(test()).select("collision_id")


def narrowed(s, d):
    selected = flt.Filters(boroughs=("Bronx", "QUEENS"), years=(1993, 1997))
    return count_by(flt.intersect_filters(selected, {"boroughs": ["QUEENS", "Manhattan"], "years": (1995, 1999)}).apply(incidents(s, d)), "borough")


def polygons_read(s, d):
    folder = scratch_dir(s, "geojson")
    features = [
        {"type": "Feature", "properties": {"BoroName": name}, "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in ring]]}}
        for name, ring in BOXES
    ]
    s.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": features}),)], "value string").write.text(folder)
    return point_in_polygon(incidents(s, d), read_polygons(s, folder, "BoroName"), "name").select("collision_id", "name")


def batches_read(s, d):
    """Two kinds of header, several files each."""
    folder = scratch_dir(s, "batches")
    rows = geocodes(s, d).select("orig_index", "collision_id", "latitude_geocode", "longitude_geocode")
    low = rows.where("batch % 2 = 0").toDF("index", "COLLISION_ID", "LATITUDE_GEOCODE", "LONGITUDE_GEOCODE")
    high = rows.where("batch % 2 = 1").toDF("INDEX", "collision id", "LAT", "LON")
    for part in (low, high):
        write_csv(part.repartition(2), folder, mode="append")
    return read_batches(s, folder, ("part-",)).select("orig_index", "collision_id", "latitude_geocode", "longitude_geocode")


def table_written(s, d):
    out = scratch_dir(s, "table")
    write_table(incidents(s, d), out)
    return read_parquet(s, out, ["collision_id", "borough"], skip_corrupt=True)


def exported(s, d):
    out = scratch_dir(s, "export")
    export(table(s, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), out)
    back = first_source(s, [f"{out}-missing", out], infer=True)
    return back.select(F.col("p_partkey").cast("bigint"), "p_name", (F.col("p_size") * 2).alias("twice"), F.col("p_retailprice").cast("double").alias("price"))


def csv_lossless(s, d):
    """Texts with quotes, commas, line breaks and blanks, some null, some empty."""
    out = scratch_dir(s, "lossless")
    odd = F.expr(r"CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(' \\n ', text, '\r\n') WHEN 3 THEN concat('\"', text, ',\\') ELSE text END")
    write_csv(table(s, d, "documents").select("doc_id", odd.alias("text"), "source"), out, lossless=True)
    back = read_csv(s, out, lossless=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"), "source")


def facets_from_table(s, d):
    folder = scratch_dir(s, "facets")
    doc = fc.facet_document(build_facets(incidents(s, d)))
    fc.key_value(doc).write.parquet(f"{folder}/metadata_parquet")
    return fc.load_facets(s, folder)


def facets_from_summary(s, d):
    return fc.load_facets(s, scratch_dir(s, "nothing"), build_summary(incidents(s, d)))


FACETS_SQL = sql(
    "SELECT DISTINCT 'boroughs' AS facet, borough AS value FROM summary UNION SELECT 'years', CAST(year AS VARCHAR) FROM summary UNION SELECT 'vehicle_types', vehicle_type FROM summary UNION SELECT 'factors', factor FROM summary",
    "scored", summary=SUMMARY_SQL,
)


def summary_in_batches(s, d):
    """The same rows in four files, one file a micro-batch."""
    source, folder = scratch_dir(s, "waves"), scratch_dir(s, "summary")
    incidents(s, d).repartition(4, "collision_id").write.parquet(source)
    stream = s.readStream.schema(incidents(s, d).schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_summary(stream, folder, scratch_dir(s, "summary-progress"))
    return rounded(read_summary(s, folder), "avg_severity")


def four_counts(s, d):
    counts = {f"{p}_{o}": F.expr(f"CAST((collision_id + {len(o)}) % {m} AS STRING)") for p, m in PARTIES.items() for o in ("injured", "killed")}
    return with_totals(incidents(s, d).withColumns(counts), "sum4").select("collision_id", "total_injured", "total_killed", "severity_score")


def four_counts_sql() -> str:
    def total(outcome: str) -> str:
        own = f"COALESCE(TRY_CAST(persons_{outcome} AS BIGINT), 0)"
        return " + ".join([own, *(f"(collision_id + {len(outcome)}) % {m}" for m in PARTIES.values())])

    return sql(
        f"SELECT collision_id, {total('injured')} AS total_injured, {total('killed')} AS total_killed, ({total('injured')}) + 5 * ({total('killed')}) AS severity_score FROM incidents",
        "incidents",
    )


def fine_factors_sql() -> str:
    pairs = ", ".join(f"('{k}', '{v}')" for k, v in factor_labels("fine").items())
    clean = "lower(trim(factor_1))"
    return sql(f"SELECT row_id, COALESCE(f.label, {clean}) AS factor FROM raw_crashes LEFT JOIN (VALUES {pairs}) AS f(name, label) ON f.name = {clean}", "raw_crashes")


def jittered(s, d):
    """Noise of 0.0005 degrees leaves points within 0.005 of their place, and moves nearly all."""
    rows = incidents(s, d).where("latitude is not null").select((jitter("latitude") - F.col("latitude")).alias("off"))
    return rows.agg(
        F.count(F.lit(1)).alias("points"), (F.max(F.abs("off")) < 0.005).alias("near"), (F.sum((F.col("off") != 0).cast("int")) > 0.99 * F.count(F.lit(1))).alias("moved"),
        (F.abs(F.avg("off")) < 0.0001).alias("centred"))


def sampled(s, d):
    """A Bernoulli sample of 5 %: its size within six standard deviations, every row one of the table's."""
    rows = table(s, d, "events")
    n, some = rows.count(), flt.sample(rows, 0.05)
    known = some.join(rows.select("event_id"), "event_id", "left_semi")
    size = F.count(F.lit(1))
    return known.agg((F.abs(size - n * 0.05) <= 6 * (n * 0.05 * 0.95) ** 0.5).alias("size_fits"), (size == some.count()).alias("all_known"))


def hotspot_totals(s, d):
    """Clusters hold every located point once, and their sizes are the sums of their points."""
    out = hotspots(incidents(s, d), 6)
    sizes = out.groupBy("cluster").agg(F.sum("points").alias("n"), F.min("cluster_size").alias("lo"), F.max("cluster_size").alias("hi"))
    return sizes.agg(F.sum("n").alias("points"), (F.count(F.lit(1)) <= 6).alias("few"), F.bool_and((F.col("lo") == F.col("n")) & (F.col("hi") == F.col("n"))).alias("sizes_fit"))


LABELS = labels_sql("all_vehicle_types", known=False)
QUERIES = {
    "years_chosen": (filtered(lambda: flt.years_in(F.year("crash_datetime"), [1994, 1996])), sql("SELECT collision_id FROM incidents WHERE year(crash_datetime) IN (1994, 1996)", "incidents")),
    "at_least_injured": (filtered(lambda: flt.at_least(to_int0("persons_injured"), 2)), sql("SELECT collision_id FROM incidents WHERE COALESCE(TRY_CAST(persons_injured AS BIGINT), 0) >= 2", "incidents")),
    "any_vehicle": (filtered(lambda: flt.any_in(parse_list("all_vehicle_types"), ["Taxi", "Bicycle"])), sql(f"SELECT collision_id FROM incidents WHERE list_has_any({LABELS}, ['Taxi', 'Bicycle'])", "incidents")),
    "any_vehicle_like": (
        filtered(lambda: flt.any_like(parse_list("all_vehicle_types"), ["['Sed", "Wagon']"])),
        sql(f"SELECT collision_id FROM incidents WHERE len(list_filter({LABELS}, lambda v: contains(v, 'Sed') OR contains(v, 'Wagon'))) > 0", "incidents"),
    ),
    "membership_as_text": (
        lambda s, d: table(s, d, "part").where(flt.in_text("p_size", [1, "15", 30.0, "30"])).select("p_partkey"),
        "SELECT p_partkey FROM part WHERE CAST(p_size AS VARCHAR) IN ('1', '15', '30.0', '30')",
    ),
    "type_contains": (
        lambda s, d: table(s, d, "part").where(contains_ci("p_type", "bRASS")).select("p_partkey"),
        "SELECT p_partkey FROM part WHERE contains(lower(p_type), 'brass')",
    ),
    "filters_intersected": (narrowed, sql("SELECT borough, COUNT(*) AS cnt FROM incidents WHERE borough = 'QUEENS' AND year(crash_datetime) BETWEEN 1995 AND 1997 GROUP BY 1", "incidents")),
    "polygons_read": (polygons_read, sql(within_sql("incidents", "boxes", "collision_id"), "incidents", boxes=boxes_sql())),
    "batches_read": (
        batches_read,
        "SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS orig_index, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey - o_orderkey % 20 % 2 AS VARCHAR) END AS collision_id, "
        "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS DOUBLE) END AS latitude_geocode, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(-o_orderkey AS DOUBLE) END AS longitude_geocode FROM orders",
    ),
    "table_written": (table_written, sql("SELECT collision_id, borough FROM incidents", "incidents")),
    "exported": (exported, "SELECT p_partkey, p_name, p_size * 2 AS twice, p_retailprice AS price FROM part"),
    "csv_lossless": (
        csv_lossless,
        "SELECT doc_id, md5(CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(' \\n ', text, chr(13), chr(10)) WHEN 3 THEN concat('\"', text, ',\\') ELSE text END) AS text_md5, source FROM documents",
    ),
    "facets_from_table": (facets_from_table, FACETS_SQL),
    "facets_from_summary": (facets_from_summary, FACETS_SQL),
    "summary_in_batches": (summary_in_batches, sql("SELECT borough, year, vehicle_type, factor, count, round(avg_severity, 6) AS avg_severity, sum_injured, sum_killed FROM summary", "scored", summary=SUMMARY_SQL)),
    "four_counts": (four_counts, four_counts_sql()),
    "factor_fine": (lambda s, d: raw_crashes(s, d).select("row_id", normalize_factor("factor_1", "fine").alias("factor")), fine_factors_sql()),
    "labels_unique": (
        lambda s, d: incidents(s, d).select("collision_id", F.array_join(unique_labels(parse_list("all_vehicle_types")), "|").alias("labels")),
        sql(f"SELECT collision_id, array_to_string(list_sort(list_distinct({LABELS})), '|') AS labels FROM incidents", "incidents"),
    ),
    "address_fallback": (
        lambda s, d: raw_crashes(s, d).select("row_id", fallback_address("on_street_name", "borough").alias("address")),
        sql("SELECT row_id, concat(COALESCE(on_street_name, ''), ', ', COALESCE(borough, '')) AS address FROM raw_crashes", "raw_crashes"),
    ),
    "jittered": (jittered, sql("SELECT COUNT(*) AS points, TRUE AS near, TRUE AS moved, TRUE AS centred FROM incidents WHERE latitude IS NOT NULL", "incidents")),
    "sample_size": (sampled, "SELECT COUNT(*) >= 0 AS size_fits, TRUE AS all_known FROM events"),
    "hotspot_totals": (hotspot_totals, sql("SELECT COUNT(*) AS points, TRUE AS few, TRUE AS sizes_fit FROM incidents WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "incidents")),
}
