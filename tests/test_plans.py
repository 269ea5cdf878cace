import json

import pytest
from pyspark.sql import functions as F

from roadtally.operators.filters import Filters
from roadtally.operators.spatial import polygon_table, rectangle
from roadtally.plans import crashes as cr
from roadtally.plans import derive, integration
from roadtally.plans import materialize as mat
from roadtally.plans import persons as pe
from roadtally.registry import tables as t
from roadtally.session import CHECKPOINT_DIR, scratch_dir
from roadtally.sources import facets as fc
from roadtally.sources import readers, writers
from roadtally.streaming import enrich, summary

SF = "/root/testdata/sf0.001"


def rows(df):
    names = sorted(df.columns)
    return sorted([tuple(r) for r in df.select(*names).collect()], key=lambda r: tuple((v is None, str(v)) for v in r))


def one(spark, **cols):
    defaults = {
        "person_type": "Occupant", "person_age": 40.0, "position_in_vehicle": "Driver", "ejection": "Not Ejected", "person_injury": "Injured",
        "emotional_status": "Conscious", "bodily_injury": "Head", "complaint": "Pain", "safety_equipment": "Lap Belt",
        "ped_location": None, "ped_action": None, "ped_role": None,
    }
    values = defaults | cols
    schema = ", ".join(f"{k} {'double' if k == 'person_age' else 'string'}" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema)


@pytest.mark.parametrize(
    "cols, want",
    [
        ({"person_age": 2.0}, "Unknown"),
        ({"person_age": 11.0}, "Unknown"),
        ({"person_age": 12.0}, "Driver"),
        ({"person_age": 2.0, "position_in_vehicle": pe.RIGHT_REAR}, "Unknown"),
        ({"person_age": 4.0, "position_in_vehicle": pe.RIGHT_REAR}, pe.RIGHT_REAR),
        ({"person_type": "Bicyclist", "person_age": 2.0}, "Unknown"),
        ({"person_type": "Bicyclist", "position_in_vehicle": pe.LAP}, "Does Not Apply"),
        ({"person_type": "Pedestrian"}, "Does Not Apply"),
        ({"position_in_vehicle": "Does Not Apply"}, "Unknown"),
        ({"person_type": "Other Motorized", "position_in_vehicle": pe.OTHER_REAR}, "Unknown"),
        ({"position_in_vehicle": None}, None),
        ({"person_age": None}, "Driver"),
    ],
)
def test_positions(spark, cols, want):
    assert pe.fix_positions(one(spark, **cols)).first()["position_in_vehicle"] == want


@pytest.mark.parametrize(
    "cols, want",
    [
        ({"ejection": "Ejected", "person_injury": "Unspecified"}, ("Ejected", "Injured", "Conscious")),
        ({"ejection": "Ejected", "person_injury": None}, ("Ejected", "Injured", "Conscious")),
        ({"ejection": "Ejected", "person_injury": "Killed"}, ("Ejected", "Killed", "Apparent Death")),
        ({"ejection": "Ejected", "emotional_status": "Unconscious"}, ("Ejected", "Killed", "Unconscious")),
        ({"person_type": "Bicyclist", "ejection": "Ejected", "emotional_status": "Unconscious"}, ("Does Not Apply", "Injured", "Unconscious")),
        ({"ejection": "Does Not Apply"}, ("Unknown", "Injured", "Conscious")),
        ({"ejection": None}, (None, "Injured", "Conscious")),
    ],
)
def test_ejection(spark, cols, want):
    got = pe.fix_ejection(one(spark, **cols)).first()
    assert (got["ejection"], got["person_injury"], got["emotional_status"]) == want


def test_pedestrians_and_equipment(spark):
    assert pe.fix_pedestrian(one(spark, person_type="Pedestrian")).count() == 0
    kept = pe.fix_pedestrian(one(spark, person_type="Pedestrian", ped_role="Driver"))
    assert kept.first()["ped_role"] == "Driver" and "ped_action" not in kept.columns
    assert pe.fix_pedestrian(one(spark, person_type=None, ped_role="x")).first()["ped_role"] == "Does Not Apply"
    assert pe.fix_equipment(one(spark, ped_role="Pedestrian")).first()["safety_equipment"] == "Unknown"
    assert pe.fix_equipment(one(spark, ped_role="In-Line Skater")).first()["safety_equipment"] == "Unknown"
    odd = pe.fix_equipment(one(spark, ped_role="In-Line Skater", safety_equipment="In-Line Skater", position_in_vehicle="x")).first()
    assert odd["position_in_vehicle"] == "Driver"
    assert pe.standardize(one(spark, complaint=None, ejection=" NaN ")).first()["complaint"] == "unknown"
    assert pe.standardize(one(spark, ejection=" NaN ")).first()["ejection"] == "unknown"
    df = spark.createDataFrame([("DRIVER ",), ("nonsense",), (None,)], "p string")
    assert [r[0] for r in df.select(pe.clean_position("p")).collect()] == ["DRIVER", "OTHER", "OTHER"]


def test_crash_pipeline(spark):
    raw = spark.createDataFrame(
        [
            (1, "06/25/2021", "4:05", None, None, 1.5, 1.5, "Unsafe Speed", None, None, "Sedan", None, "5 AV N", None, None),
            (1, "06/25/2021", "4:05", "x", "y", 1.5, 1.5, "Glare", None, None, "Sedan", None, "5 AV N", None, None),
            (2, "bad", "4:05", None, None, None, None, "Unspecified", "80", None, "Bus", "Taxi", None, None, None),
            (3, "06/26/2021", "4:05", None, None, None, None, "Texting", "80", "Glare", "Bus", "Taxi", "MAIN", None, "OFF"),
            (4, "06/26/2021", "4:05", None, None, 0.0, 0.0, "Texting", None, None, "Bus", None, None, None, None),
            (5, "06/26/2021", "4:05", None, None, 8.0, 8.0, "Texting", None, None, "Bus", None, None, None, None),
        ],
        "collision_id int, crash_date string, crash_time string, borough string, zip_code string, latitude double, longitude double, "
        "factor_1 string, factor_2 string, factor_3 string, vehicle_1 string, vehicle_2 string, on_street_name string, cross_street_name string, off_street_name string",
    )
    raw = raw.withColumns({"factor_4": F.lit(None).cast("string"), "factor_5": F.lit(None).cast("string"), "n": F.monotonically_increasing_id()})
    layer = polygon_table(spark, [rectangle("A", 1, 1, 2, 2)])
    geocodes = spark.createDataFrame([(0, "main, off, new york, ny", 1.2, 1.3)], "batch int, full_address string, latitude_geocode double, longitude_geocode double")
    got = {r["collision_id"]: r for r in cr.clean_crashes(raw, layer, layer, geocodes, order=["n"]).collect()}
    assert sorted(got) == [1, 3]
    assert got[1]["borough"] == "A" and got[1]["factor_1"] == "speeding" and got[1]["full_address"] == "5 AVENUE N, New York, NY"
    assert got[3]["all_contributing_factors"] == ["cell phone use", "visibility issue"] and got[3]["factor_2"] == "unspecified"
    assert got[3]["all_vehicle_types"] == ["Bus", "Taxi"] and got[3]["latitude"] == 1.2
    assert cr.unresolved(cr.clean_basics(raw)).count() == 1


def test_portal_names(spark):
    raw = spark.createDataFrame([("1", "x", "(1,2)", "a", "40.5")], "`COLLISION_ID` string, `VEHICLE TYPE CODE 1` string, LOCATION string, `CONTRIBUTING FACTOR VEHICLE 2` string, LATITUDE string")
    out = cr.from_portal(raw)
    assert out.columns == ["collision_id", "vehicle_1", "factor_2", "latitude"] and out.first()["latitude"] == 40.5


def test_merge_fills_hot_collisions_the_same(spark):
    people = t.persons(spark, SF).withColumnRenamed("person_datetime", "crash_datetime")
    plain = integration.merge(people, t.incidents(spark, SF), hot={})
    hot = integration.merge(people, t.incidents(spark, SF), hot={3: 0.4, 4: 0.01, None: 0.1})
    assert rows(plain) == rows(hot)
    filled = integration.fill_streets(people.withColumn("on_street_name", F.lit(None).cast("string")))
    assert filled.first()["on_street_name"] == "Unknown Street"


def test_summary_counts_every_pair_once(spark):
    crashes = t.incidents(spark, SF)
    from roadtally.operators.columns import label_lists

    lists = label_lists(crashes, "all_vehicle_types", "all_contributing_factors")
    pairs = lists.agg(F.sum(F.size("vehicles") * F.size("factors"))).first()[0]
    assert derive.build_summary(crashes).agg(F.sum("count")).first()[0] == pairs
    persons_only = derive.build_summary(crashes, mode="persons")
    assert persons_only.agg(F.sum("count")).first()[0] == pairs
    arrays = crashes.withColumn("all_vehicle_types", F.split("all_vehicle_types", ","))
    assert derive.build_summary(arrays).count() > 0


@pytest.mark.parametrize("name", list(mat.DIMENSIONS))
def test_materialised_answers_equal_live_ones(spark, name):
    merged = t.merged(spark, SF)
    assert rows(mat.shape_answer(mat.answer_cells(merged), name)) == rows(mat.LIVE[name](merged))


def test_answer_routing(spark, tmp_path):
    merged = t.merged(spark, SF)
    folder = str(tmp_path / "answers")
    live = rows(mat.answer(spark, "severity_by_gender", merged, folder))
    mat.materialize(merged, folder)
    stored = mat.answer(spark, "severity_by_gender", merged, folder)
    assert rows(stored) == live and "answers/severity_by_gender" in stored.inputFiles()[0]
    filtered = mat.answer(spark, "severity_by_gender", merged, folder, Filters(boroughs=("Bronx",)))
    assert all("answers" not in f for f in filtered.inputFiles()) and rows(filtered) != live
    assert mat.answer(spark, "safety_vs_injury", merged, folder).count() > 0


def test_grouping_sets_read_the_table_once(spark):
    plan = mat.answer_cells(t.persons(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_rewrite(spark, tmp_path):
    out = str(tmp_path / "copy")
    source = f"{SF}/orders.parquet"
    report = writers.rewrite_partitioned(t.incidents(spark, SF), out, max_rows=100, source=source).first()
    assert report["rows"] == t.incidents(spark, SF).count() and report["bytes_in"] > 0 and report["bytes_out"] > 0
    with pytest.raises(FileExistsError):
        writers.rewrite_partitioned(t.incidents(spark, SF), out)
    back = spark.read.parquet(out)
    plan = back.where("YEAR = 1995")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in plan
    assert back.drop("YEAR").exceptAll(t.incidents(spark, SF)).count() == 0
    flat = str(tmp_path / "flat")
    writers.rewrite_partitioned(t.incidents(spark, SF), flat, partition_cols=[])
    assert spark.read.parquet(flat).count() == report["rows"]


def test_tables_and_sources(spark, tmp_path):
    df = spark.createDataFrame([(" a", None, 'q"x'), ("b ", "2", "y,z")], "a string, b string, c string")
    csv, pq = str(tmp_path / "t.csv"), str(tmp_path / "t.parquet")
    writers.write_csv(df, csv)
    writers.write_table(df, pq)
    assert rows(readers.read_csv(spark, csv)) == rows(df)
    assert dict(readers.read_csv(spark, csv, infer=True).dtypes)["b"] == "int"
    assert readers.read_csv(spark, csv, schema="a string, b int, c string").schema["b"].dataType.typeName() == "integer"
    assert readers.read_parquet(spark, pq, ["c"]).columns == ["c"] and readers.columns(spark, pq) == ["a", "b", "c"]
    assert readers.first_source(spark, [str(tmp_path / "no"), csv, pq]).count() == 2
    assert readers.first_source(spark, [str(tmp_path / "no")]) is None
    writers.export(df.repartition(2, "a"), str(tmp_path / "one"), single_file=True)
    writers.export(df.repartition(2, "a"), str(tmp_path / "many"))
    assert readers.first_source(spark, [str(tmp_path / "many")], infer=True).schema["b"].dataType.typeName() == "integer"
    odd = spark.createDataFrame([("a\nb", ""), (None, "x\\ny\r\n\\"), ('"q",\\N', "\\N"), (" ", None)], "a string, b string")
    writers.write_csv(odd, str(tmp_path / "odd"), lossless=True)
    assert rows(readers.read_csv(spark, str(tmp_path / "odd"), lossless=True)) == rows(odd)
    writers.write_csv(odd.where("a = 'a\\nb'"), str(tmp_path / "breaks"))
    assert readers.read_csv(spark, str(tmp_path / "breaks"), multi_line=True).first()["a"] == "a\nb"
    assert len(readers.list_files(spark, str(tmp_path / "one"), ("part-",))) == 1
    assert rows(readers.read_csv(spark, str(tmp_path / "many"))) == rows(df)
    (tmp_path / "t.parquet" / "bad.parquet").write_bytes(b"nothing")
    assert readers.read_parquet(spark, pq, skip_corrupt=True, schema=df.schema).count() == 2


def test_batches_with_drifting_names(spark, tmp_path):
    (tmp_path / "geocoded_batch_0.csv").write_text('index,FULL ADDRESS,LATITUDE_GEOCODE,LONGITUDE_GEOCODE\n1.0,"A, B",1.5,2.5\n')
    (tmp_path / "geocoded_batch_1.csv").write_text("COLLISION_ID,address ,lat,lon\n77,C,3.5,\n")
    (tmp_path / "batch_2_partial.csv").write_text("COLLISION_ID,address ,lat,lon\n78,D,bad,4.5\n")
    (tmp_path / "geocoded_batch_3.csv").write_text("")
    (tmp_path / "other.csv").write_text("lat\n1\n")
    got = {r["full_address"]: r for r in readers.read_batches(spark, str(tmp_path)).collect()}
    assert set(got) == {"A, B", "C", "D"}
    assert got["A, B"]["orig_index"] == 1 and got["C"]["collision_id"] == "77" and got["C"]["longitude_geocode"] is None
    assert got["D"]["latitude_geocode"] is None and got["D"]["longitude_geocode"] == 4.5 and "batch_2" in got["D"]["batch"]
    with pytest.raises(FileNotFoundError):
        readers.read_batches(spark, str(tmp_path), ("nothing",))


def test_geojson(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    doc = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"BoroName": "A", "n": 1}, "geometry": {"type": "Polygon", "coordinates": [square]}},
            {"type": "Feature", "properties": {"BoroName": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [[[5, 5], [6, 5], [6, 6]]]]}},
        ],
    }
    path = tmp_path / "p.geojson"
    path.write_text(json.dumps(doc, indent=1))
    got = readers.read_polygons(spark, str(path), "BoroName").orderBy("place").collect()
    assert [(r["place"], r["name"], len(r["ring"])) for r in got] == [(0, "A", 5), (1, "B", 5), (1, "B", 3)]
    from roadtally.operators.spatial import point_in_polygon

    df = spark.createDataFrame([(1.0, 1.0), (5.2, 5.5)], "latitude double, longitude double")
    assert rows(point_in_polygon(df, readers.read_polygons(spark, str(path), "BoroName"), "b").select("b")) == [("A",), ("B",)]


def test_facets(spark, tmp_path):
    facets = derive.build_facets(t.incidents(spark, SF))
    folder = str(tmp_path / "f")
    assert rows(fc.load_facets(spark, folder)) == []
    from_summary = rows(fc.load_facets(spark, folder, derive.build_summary(t.incidents(spark, SF))))
    fc.write_facets(facets, folder, columns_count=9)
    as_json = rows(fc.load_facets(spark, folder))
    assert as_json == from_summary
    table = spark.read.parquet(f"{folder}/metadata_parquet")
    assert {r["key"] for r in table.collect()} == {"boroughs", "years", "vehicle_types", "factors", "columns_count"}
    only_table = str(tmp_path / "g")
    table.write.parquet(f"{only_table}/metadata_parquet")
    assert rows(fc.load_facets(spark, only_table)) == as_json
    many = spark.range(100_001).select(F.lit("factors").alias("facet"), F.col("id").cast("string").alias("value"))
    assert len(fc.facet_document(many).first()["factors"]) == 100_001
    fc.write_facets(many, str(tmp_path / "many"))
    assert fc.load_facets(spark, str(tmp_path / "many")).count() == 100_001


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get(CHECKPOINT_DIR))


def test_streamed_summary_in_waves_equals_batch(spark, tmp_path):
    source, folder, progress = tmp_path / "in", str(tmp_path / "sums"), str(tmp_path / "progress")
    crashes = t.incidents(spark, SF)
    for wave in (0, 1, 2):
        crashes.where(F.col("collision_id") % 3 == wave).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(crashes.schema).parquet(str(source))
        summary.stream_summary(stream, folder, progress)
    want = rows(derive.build_summary(crashes))
    assert rows(summary.read_summary(spark, folder)) == want
    batch = crashes.where(F.col("collision_id") % 3 == 2)
    summary.write_partial(batch, 2, folder)
    assert rows(summary.read_summary(spark, folder)) == want
    into = str(tmp_path / "compact")
    summary.compact(spark, folder, into)
    assert rows(summary.read_summary(spark, into)) == want
    with pytest.raises(FileNotFoundError):
        summary.read_summary(spark, str(tmp_path / "none"))


def test_a_stream_that_times_out_raises(spark, tmp_path):
    crashes = t.incidents(spark, SF)
    crashes.repartition(8).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(crashes.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(TimeoutError):
        summary.stream_summary(stream, str(tmp_path / "sums"), str(tmp_path / "progress"), timeout_s=0.01)
    summary.stream_summary(stream, str(tmp_path / "sums"), str(tmp_path / "progress"))
    assert rows(summary.read_summary(spark, str(tmp_path / "sums"))) == rows(derive.build_summary(crashes))


def test_live_summary(spark, tmp_path):
    crashes = t.incidents(spark, SF)
    source = str(tmp_path / "in")
    crashes.repartition(3).write.parquet(source)
    live = summary.live_summary(spark.readStream.schema(crashes.schema).option("maxFilesPerTrigger", 1).parquet(source))
    query = live.writeStream.outputMode("complete").format("memory").queryName("live_summary").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("live_summary")) == rows(derive.build_summary(crashes))


def test_enrichment_resumes(spark, tmp_path):
    source, folder, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    lookup = spark.createDataFrame([(0, "a", 1.0, 2.0)], "batch int, full_address string, latitude_geocode double, longitude_geocode double")
    schema = "collision_id int, full_address string, latitude double, longitude double"
    for wave in (1, 2):
        spark.createDataFrame([(wave, " A", None, None), (10 + wave, "b", 9.0, None)], schema).write.mode("append").parquet(source)
        enrich.enrich_stream(spark.readStream.schema(schema).parquet(source), lookup, folder, progress)
    got = {r["collision_id"]: (r["latitude"], r["longitude"], r["batch_id"]) for r in spark.read.parquet(folder).collect()}
    assert got == {1: (1.0, 2.0, 0), 2: (1.0, 2.0, 1), 11: (9.0, None, 0), 12: (9.0, None, 1)}
