"""Collision tables derived from the driver's tables, in Spark and in SQL.

Every view covers the whole of its source table: one crash per order, one
person per event.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadtally.operators.joins import integrate
from roadtally.operators.spatial import polygon_table, rectangle

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# Expressions are written once; {str}, {div} and quotes differ between the engines.
_INCIDENTS = [
    ("collision_id", "o_orderkey"),
    ("crash_datetime", "{hours}"),
    (
        "borough",
        "CASE o_custkey % 6 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'brooklyn ' WHEN 2 THEN 'QUEENS' "
        "WHEN 3 THEN 'Bronx' WHEN 4 THEN 'Staten Island' END",
    ),
    ("latitude", "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(40.5 AS DOUBLE) + CAST(o_custkey * 37 % 4000 AS DOUBLE) / CAST(10000 AS DOUBLE) END"),
    ("longitude", "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(-74.25 AS DOUBLE) + CAST(o_custkey * 53 % 5500 AS DOUBLE) / CAST(10000 AS DOUBLE) END"),
    ("persons_injured", "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS {str}) END"),
    ("persons_killed", "CASE WHEN o_orderkey % 97 = 0 THEN '1' ELSE '0' END"),
    (
        "all_vehicle_types",
        "CASE o_orderkey % 5 WHEN 0 THEN {q}['Sedan', 'Bicycle']{q} WHEN 1 THEN 'Taxi, Van' "
        "WHEN 2 THEN {q}['SUV/Station Wagon']{q} WHEN 3 THEN '' END",
    ),
    (
        "all_contributing_factors",
        "CASE o_orderkey % 4 WHEN 0 THEN {q}['speeding', 'tailgating']{q} WHEN 1 THEN 'driver inattention' "
        "WHEN 2 THEN 'speeding; road defect' END",
    ),
]
_PERSONS = [
    ("unique_id", "event_id"),
    ("collision_id", "CASE WHEN event_id % 50 = 0 THEN event_id + 100000000 ELSE event_id {div} 3 END"),
    ("person_datetime", "ts"),
    ("person_injury", "CASE event_type WHEN 'error' THEN 'Killed' WHEN 'click' THEN 'Injured' WHEN 'view' THEN 'Unspecified' WHEN 'signup' THEN ' no injury ' END"),
    ("person_type", "CASE user_id % 4 WHEN 0 THEN 'Occupant' WHEN 1 THEN 'Pedestrian' WHEN 2 THEN 'Bicyclist' ELSE 'Other Motorized' END"),
    ("person_sex", "CASE user_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END"),
    (
        "person_age",
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 101 = 0 THEN '18.5' "
        "ELSE CAST((user_id * 7 + event_id) % 130 - 3 AS {str}) END",
    ),
    ("ejection", "CASE event_id % 5 WHEN 0 THEN 'Ejected' WHEN 1 THEN 'Not Ejected' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'Does Not Apply' END"),
    ("position_in_vehicle", "CASE event_id % 4 WHEN 0 THEN 'Driver' WHEN 1 THEN 'Does Not Apply' WHEN 2 THEN 'Riding/Hanging on Outside' ELSE 'Unknown' END"),
    ("safety_equipment", "CASE event_id % 4 WHEN 0 THEN '[Lap Belt]' WHEN 1 THEN ' Helmet ' WHEN 2 THEN '' END"),
]
_RAW_CRASHES = [
    ("collision_id", "o_orderkey - o_orderkey % 20 % 2"),
    ("row_id", "o_orderkey"),
    ("crash_date", "CASE WHEN o_orderkey % 41 = 0 THEN 'bad' WHEN o_orderkey % 43 = 0 THEN NULL ELSE {mdy} END"),
    ("crash_time", "concat(CAST(o_orderkey % 24 AS {str}), ':', lpad(CAST(o_orderkey % 60 AS {str}), 2, '0'))"),
    (
        "factor_1",
        "CASE o_orderkey % 7 WHEN 0 THEN 'Unsafe Speed' WHEN 1 THEN ' driver inattention/distraction ' WHEN 2 THEN 'Unspecified' "
        "WHEN 4 THEN 'Glare' WHEN 5 THEN 'TEXTING' WHEN 6 THEN 'Something New' END",
    ),
    ("factor_2", "CASE o_custkey % 4 WHEN 0 THEN 'Unspecified' WHEN 2 THEN 'Passing Too Closely' WHEN 3 THEN '80' END"),
    ("factor_3", "CASE WHEN o_orderkey % 9 = 0 THEN 'Illnes' END"),
    ("factor_4", "CASE WHEN o_orderkey % 90 = 0 THEN 'Fell Asleep' END"),
    ("factor_5", "CAST(NULL AS {str})"),
    (
        "vehicle_1",
        "CASE o_orderkey % 8 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'PICK-UP TRUCK' WHEN 2 THEN 'e-bike' "
        "WHEN 3 THEN 'Station Wagon/Sport Utility Vehicle' WHEN 5 THEN 'forklift' WHEN 6 THEN 'Box Truck' WHEN 7 THEN 'Taxi' END",
    ),
    ("vehicle_2", "CASE o_custkey % 5 WHEN 0 THEN 'Bike' WHEN 1 THEN 'School Bus' WHEN 2 THEN '4 dr sedan' WHEN 4 THEN 'NYC Ambula' END"),
    ("on_street_name", "CASE o_orderkey % 5 WHEN 0 THEN 'E. 14 ST ' WHEN 1 THEN '5 AV N' WHEN 2 THEN 'BED-STUY RD X' WHEN 4 THEN '  broadway   ave  east ' END"),
    ("cross_street_name", "CASE o_custkey % 3 WHEN 0 THEN 'Main St W' WHEN 2 THEN '' END"),
    ("off_street_name", "CASE WHEN o_orderkey % 7 = 0 THEN '12 OCEAN PKWY S' END"),
    ("borough", "CASE o_custkey % 6 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Brooklyn' END"),
    ("zip_code", "CASE WHEN o_custkey % 4 = 0 THEN CAST(10000 + o_custkey % 90 AS {str}) WHEN o_custkey % 4 = 1 THEN '1000A' END"),
    ("latitude", "CASE WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 13 <> 0 THEN CAST(40.5 AS DOUBLE) + CAST(o_custkey * 37 % 4000 AS DOUBLE) / CAST(10000 AS DOUBLE) END"),
    ("longitude", "CASE WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 13 <> 0 THEN CAST(-74.25 AS DOUBLE) + CAST(o_custkey * 53 % 5500 AS DOUBLE) / CAST(10000 AS DOUBLE) END"),
    ("persons_injured", "CAST(o_orderkey % 3 AS {str})"),
    ("persons_killed", "'0'"),
]
_RAW_PERSONS = [
    ("unique_id", "event_id"),
    ("collision_id", "event_id {div} 3"),
    ("crash_date", "CASE WHEN event_id % 47 = 0 THEN '12/31/2999' WHEN event_id % 53 = 0 THEN NULL ELSE {mdy} END"),
    ("crash_time", "CASE WHEN event_id % 59 = 0 THEN NULL ELSE concat(CAST(event_id % 24 AS {str}), ':', lpad(CAST(event_id % 60 AS {str}), 2, '0')) END"),
    ("person_id", "CASE event_id % 4 WHEN 0 THEN CAST(1000000 + event_id AS {str}) WHEN 1 THEN CAST(event_id % 10 AS {str}) WHEN 2 THEN concat('p-', CAST(event_id AS {str})) ELSE CAST(event_id % 1000 + 10 AS {str}) END"),
    ("person_type", "CASE user_id % 4 WHEN 0 THEN 'Occupant' WHEN 1 THEN 'Pedestrian' WHEN 2 THEN 'Bicyclist' ELSE 'Other Motorized' END"),
    ("person_injury", "CASE event_type WHEN 'error' THEN 'Killed' WHEN 'click' THEN 'Injured' WHEN 'view' THEN 'Unspecified' END"),
    ("vehicle_id", "CASE WHEN event_id % 19 <> 0 THEN CAST(event_id * 7 AS {str}) END"),
    ("person_age", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((user_id * 7 + event_id) % 130 - 3 AS DOUBLE) END"),
    ("person_sex", "CASE user_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END"),
    (
        "position_in_vehicle",
        "CASE event_id % 9 WHEN 0 THEN 'Driver' WHEN 1 THEN 'Does Not Apply' WHEN 2 THEN 'Riding/Hanging on Outside' WHEN 3 THEN 'Unknown' "
        "WHEN 4 THEN 'Right rear passenger or motorcycle sidecar passenger' WHEN 5 THEN 'Middle rear seat, or passenger lying across a seat' "
        "WHEN 6 THEN 'Front passenger, if two or more persons, including the driver, are in the front seat' "
        "WHEN 7 THEN 'Left rear passenger, or rear passenger on a bicycle, motorcycle, snowmobile' END",
    ),
    ("ejection", "CASE event_id % 5 WHEN 0 THEN 'Ejected' WHEN 1 THEN 'Not Ejected' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'Does Not Apply' END"),
    ("emotional_status", "CASE event_id % 6 WHEN 0 THEN 'Unconscious' WHEN 1 THEN 'Conscious' WHEN 2 THEN 'Does Not Apply' WHEN 3 THEN 'Shock' END"),
    ("bodily_injury", "CASE user_id % 7 WHEN 0 THEN 'Head' WHEN 1 THEN 'Back' WHEN 2 THEN 'Does Not Apply' WHEN 3 THEN 'Entire Body' WHEN 4 THEN 'Neck' END"),
    ("complaint", "CASE event_id % 8 WHEN 0 THEN 'Concussion' WHEN 1 THEN 'Does Not Apply' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'Pain' WHEN 4 THEN ' Bleeding' WHEN 5 THEN 'Pain' END"),
    ("safety_equipment", "CASE event_id % 4 WHEN 0 THEN 'Lap Belt' WHEN 1 THEN 'Helmet' WHEN 2 THEN 'Unknown' END"),
    ("ped_location", "CASE WHEN event_id % 3 = 0 THEN 'Intersection' END"),
    ("ped_action", "CASE WHEN event_id % 2 = 0 THEN 'Crossing' END"),
    ("ped_role", "CASE event_id % 7 WHEN 0 THEN 'Pedestrian' WHEN 1 THEN 'In-Line Skater' WHEN 2 THEN 'Driver' END"),
    ("contributing_factor_1", "CASE WHEN event_id % 10 = 0 THEN 'Glare' END"),
    ("contributing_factor_2", "CASE WHEN event_id % 100 = 0 THEN 'Glare' END"),
]


def _spark_form(expr: str, ts: str, key: str) -> str:
    return expr.format(
        str="STRING", div="div", q='"', hours=f"{ts} + make_interval(0, 0, 0, 0, CAST({key} % 24 AS INT), 0, 0)",
        mdy=f"date_format({ts}, 'MM/dd/yyyy')",
    )


def _sql_form(expr: str, ts: str, key: str) -> str:
    quote = "\x00"
    text = expr.format(
        str="VARCHAR", div="//", q=quote, hours=f"{ts} + to_hours(CAST({key} % 24 AS INTEGER))", mdy=f"strftime({ts}, '%m/%d/%Y')"
    )
    parts = text.split(quote)
    return "".join("'" + p.replace("'", "''") + "'" if i % 2 else p for i, p in enumerate(parts))


def _view(cols, source, ts, key):
    exprs = [f"{_spark_form(e, ts, key)} AS {n}" for n, e in cols]

    def read(spark: SparkSession, sf: str) -> DataFrame:
        return table(spark, sf, source).selectExpr(*exprs)

    def stream(spark: SparkSession, sf: str) -> DataFrame:
        schema = table(spark, sf, source).schema
        files = spark.readStream.schema(schema).option("pathGlobFilter", f"{source}.parquet").parquet(sf)
        return files.selectExpr(*exprs)

    sql = "SELECT " + ", ".join(f"{_sql_form(e, ts, key)} AS {n}" for n, e in cols) + f" FROM {source}"
    return read, stream, sql


incidents, incidents_stream, INCIDENTS_SQL = _view(_INCIDENTS, "orders", "o_orderdate", "o_orderkey")
persons, persons_stream, PERSONS_SQL = _view(_PERSONS, "events", "ts", "event_id")
raw_crashes, raw_crashes_stream, RAW_CRASHES_SQL = _view(_RAW_CRASHES, "orders", "o_orderdate", "o_orderkey")
raw_persons, raw_persons_stream, RAW_PERSONS_SQL = _view(_RAW_PERSONS, "events", "ts", "event_id")


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return integrate(persons(spark, sf), incidents(spark, sf))


VIEWS = {
    "incidents": INCIDENTS_SQL,
    "persons": PERSONS_SQL,
    "raw_crashes": RAW_CRASHES_SQL,
    "raw_persons": RAW_PERSONS_SQL,
    "merged": "SELECT * FROM persons LEFT JOIN incidents USING (collision_id)",
    "scored": "SELECT *, COALESCE(TRY_CAST(persons_injured AS BIGINT), 0) AS total_injured, "
    "COALESCE(TRY_CAST(persons_killed AS BIGINT), 0) AS total_killed, "
    "COALESCE(TRY_CAST(persons_injured AS BIGINT), 0) + 5 * COALESCE(TRY_CAST(persons_killed AS BIGINT), 0) AS severity_score FROM incidents",
    "merged_scored": "SELECT * FROM persons LEFT JOIN scored USING (collision_id)",
}
NEEDS = {
    "merged": ["persons", "incidents"],
    "scored": ["incidents"],
    "merged_scored": ["persons", "incidents", "scored"],
}


def sql(body: str, *views: str, **more: str) -> str:
    """SQL text with the named views (and further ones) as CTEs ahead of the body."""
    names: list[str] = []
    for v in views:
        for n in (*NEEDS.get(v, []), v):
            if n not in names:
                names.append(n)
    ctes = [(n, VIEWS[n]) for n in names] + list(more.items())
    head = ", ".join(f"{n} AS ({q})" for n, q in ctes)
    return f"WITH {head} {body}" if head else body


# Five boxes over the crash area; the strip between 40.68 and 40.70 is in none of them.
BOXES = [
    rectangle("Staten Island", -74.25, 40.5, -74.05, 40.68),
    rectangle("Brooklyn", -74.05, 40.5, -73.85, 40.68),
    rectangle("Queens", -73.85, 40.5, -73.70, 40.68),
    rectangle("Manhattan", -74.25, 40.70, -73.95, 40.9),
    rectangle("Bronx", -73.95, 40.70, -73.70, 40.9),
]


def boxes(spark: SparkSession) -> DataFrame:
    return polygon_table(spark, BOXES)


def zip_boxes(spark: SparkSession) -> DataFrame:
    """Two ZIP areas side by side with a gap at longitude -74.00 to -73.99."""
    return polygon_table(
        spark, [rectangle("10001", -74.25, 40.5, -74.0, 40.9), rectangle("10002", -73.99, 40.5, -73.70, 40.9)]
    )


def labels_sql(c: str, known: bool = True) -> str:
    """List text of the three spellings in `incidents` -> array, in SQL."""
    bare = f"replace(replace(replace({c}, '[', ''), ']', ''), '''', '')"
    sep = f"CASE WHEN contains({bare}, ',') THEN ',' WHEN contains({bare}, ';') THEN ';' ELSE '|' END"
    items = f"list_filter(list_transform(string_split(COALESCE({bare}, ''), {sep}), lambda x: trim(x)), lambda x: x <> '')"
    return f"CASE WHEN len({items}) = 0 THEN ['Unknown'] ELSE {items} END" if known else items
