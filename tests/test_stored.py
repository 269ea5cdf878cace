"""Cubes, corrections, sketches and samples by key."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from roadtally.operators import sketches, spatial
from roadtally.operators.filters import Filters, sample, search
from roadtally.plans import cube, pyramid, textindex
from roadtally.plans import materialize as mat
from roadtally.plans.derive import build_summary
from roadtally.registry import tables as t
from roadtally.streaming import corrections as c

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def cubes(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cubes"))
    cube.build_cubes(t.merged(spark, SF), folder)
    return folder


FILTERS = {
    "none": (Filters(), "all"),
    "place": (Filters(boroughs=("Bronx",), years=(1993, 1997)), "place"),
    "type": (Filters(person_types=("occupant",), sexes=("m",), injured_only=True), "type"),
    "person": (Filters(min_age=20, max_age=50, boroughs=("Bronx", "Manhattan")), "person"),
}


@pytest.mark.parametrize("kind", list(FILTERS))
@pytest.mark.parametrize("name", ["safety_vs_injury", "injuries_by_hour", "person_type_injury_rates", "motorcycle_vs_car_fatalities"])
def test_cube_answers_equal_live_ones(spark, cubes, name, kind):
    merged, (filters, grain) = t.merged(spark, SF), FILTERS[kind]
    assert cube.route(spark, name, cubes, filters) == grain
    got = cube.answer(spark, name, merged, cubes, filters)
    assert rows(got) == rows(mat.LIVE[name](merged, filters))
    # only this grain's cells are read, and of them only this question's
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all(f"/{grain}/question=" in f for f in got.inputFiles())
    assert "PartitionFilters: [isnotnull(question" in plan


def test_cubes_count_equal_rows_once_and_multiply_none(spark, tmp_path):
    merged = t.merged(spark, SF).where("unique_id % 7 = 0")
    thrice = merged.unionByName(merged).unionByName(merged).coalesce(1)
    one, three = (cube._facts_of(m, cube._filter_columns(m)) for m in (merged, thrice))
    assert one.count() == three.count() and three.agg(F.sum("__cnt")).first()[0] == 3 * merged.count()
    # no copy of a row for each question; a question's aggregate has its own dimensions as keys
    plan = cube.finest(thrice)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "keys=[safety" in plan and not re.search(r"keys=\[[^\]]*safety[^\]]*age_group", plan)
    cube.build_cubes(thrice, str(tmp_path / "cubes"))
    for name in cube.DIMENSIONS:
        for filters in (Filters(), Filters(min_age=20, boroughs=("Bronx", "Manhattan"))):
            assert rows(cube.answer(spark, name, thrice, str(tmp_path / "cubes"), filters)) == rows(mat.LIVE[name](thrice, filters)), name


def test_filters_that_no_cube_holds_are_answered_live(spark, cubes):
    merged = t.merged(spark, SF)
    for filters in (Filters(factors=("speeding",)), Filters(facets={"ejection": ("Ejected",)})):
        assert cube.route(spark, "age_group_counts", cubes, filters) is None
    facet = Filters(facets={"ejection": ("Ejected",)})
    assert rows(cube.answer(spark, "age_group_counts", merged, cubes, facet)) == rows(mat.LIVE["age_group_counts"](merged, facet))
    assert cube.route(spark, "age_group_counts", cubes + "/nothing", Filters()) is None


def crashes(spark, entries):
    """(key, version, deleted, borough, killed) rows."""
    data = [(k, v, g, b, f"199{(k or 0) % 3}-01-0{(k or 0) % 7 + 1} 10:00:00", "Sedan, Taxi" if (k or 0) % 2 else "Van", "speeding", "1", n) for k, v, g, b, n in entries]
    return spark.createDataFrame(data, "collision_id long, version long, deleted boolean, borough string, crash_datetime string, all_vehicle_types string, "
                                 "all_contributing_factors string, persons_injured string, persons_killed string")


@pytest.mark.parametrize("buckets", [3, c.BUCKETS])
def test_corrections_leave_exact_sums(spark, tmp_path, buckets):
    pick = random.Random(buckets)
    folder = str(tmp_path / "ledger")
    batches, best = [], {}
    for _ in range(4):
        batch = [(pick.randrange(25), pick.randrange(1, 30), pick.random() < 0.2, pick.choice(["Bronx", "Queens", None]), str(pick.randrange(3))) for _ in range(20)]
        seen = {}
        for row in batch:
            seen.setdefault((row[0], row[1]), row)
        batches.append(list(seen.values()) + [(None, 5, False, "Bronx", "0")])
    merge = lambda i: c.merge_batch(crashes(spark, batches[i]), i, folder, "collision_id", "version", "deleted", buckets=buckets)
    for i, batch in enumerate(batches):
        merge(i)
        for row in batch:
            if row[0] is not None and (row[0] not in best or row[1] > best[row[0]][1]):
                best[row[0]] = row
        want = sorted(rows(build_summary(crashes(spark, [r for r in best.values() if not r[2]]))), key=str)
        assert sorted(rows(c.corrected_summary(spark, folder)), key=str) == want
    # batches that are run again change nothing
    for i in (3, 1, 3):
        merge(i)
    assert sorted(rows(c.corrected_summary(spark, folder)), key=str) == want
    assert c.corrected_cells(spark, folder, as_of=0).count() <= c.corrected_cells(spark, folder).count() + 40


def test_a_batch_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    c.merge_batch(crashes(spark, [(k, 1, False, "Bronx", "0") for k in range(200)]), 0, folder, "collision_id", "version", "deleted")
    c.merge_batch(crashes(spark, [(7, 2, False, "Queens", "0")]), 1, folder, "collision_id", "version", "deleted")
    touched = spark.read.parquet(f"{folder}/manifest").where("batch_id = 1").count()
    held = spark.read.parquet(f"{folder}/rows").where("batch_id = 1")
    assert touched == 1 and held.select("_bucket").distinct().count() == 1 and held.count() < 20


def test_a_batch_writes_the_rows_that_won_only(spark, tmp_path, monkeypatch):
    folder, alive = str(tmp_path / "ledger"), {}
    monkeypatch.setattr(c, "DELTAS", 2, raising=False)
    for i in range(6):
        batch = [(k, i + 1, k == 3 * i, f"Place {i}", str(k % 2)) for k in range(0 if i == 0 else 3, 400 if i == 0 else 8 + i)]
        for _ in range(2 if i in (2, 4) else 1):
            c.merge_batch(crashes(spark, batch), i, folder, "collision_id", "version", "deleted", buckets=2)
        alive.update({r[0]: r for r in batch})
        want = build_summary(crashes(spark, [r for r in alive.values() if not r[2]]))
        assert sorted(rows(c.corrected_summary(spark, folder)), key=str) == sorted(rows(want), key=str)
    sizes = {r["batch_id"]: r["count"] for r in spark.read.parquet(f"{folder}/rows").groupBy("batch_id").count().collect()}
    # the fourth batch finds each bucket in three and writes them whole, the others what won
    assert sizes == {0: 400, 1: 6, 2: 7, 3: 400, 4: 9, 5: 10}
    files = spark.read.parquet(f"{folder}/rows").where("batch_id = 0").inputFiles()
    assert len([f for f in files if "batch_id=0/" in f]) == 2


def test_sketches_roll_up_within_their_error(spark):
    frame = spark.range(60_000).selectExpr("id % 7 as day", "id % 3 as place", "id div 2 as crash")
    fine = sketches.distinct_sketches(frame, "crash", ["day", "place"])
    for by in (["day"], ["place"], []):
        got = sketches.estimated(sketches.rolled_up(fine, by), "about") if by else sketches.estimated(fine.agg(F.hll_union_agg("sketch").alias("sketch")), "about")
        exact = frame.groupBy(*by).agg(F.countDistinct("crash").alias("n"))
        pairs = got.join(exact, by).select("about", "n") if by else got.crossJoin(exact).select("about", "n")
        assert all(abs(a - n) <= 3 * sketches.standard_error() * n for a, n in rows(pairs))
    # merged parts are the whole's sketch
    whole = sketches.estimated(sketches.distinct_sketches(frame, "crash", ["day"]), "about")
    assert sorted(rows(whole)) == sorted(rows(sketches.estimated(sketches.rolled_up(fine, ["day"]), "about")))


def test_samples_by_key_do_not_depend_on_the_layout(spark):
    frame = spark.range(5000).selectExpr("id", "id % 700 as crash")
    kept = {f: {r["id"] for r in sample(frame.repartition(n), f, key=["crash"]).collect()} for f, n in ((0.1, 3), (0.4, 7))}
    assert kept[0.1] == {r["id"] for r in sample(frame.orderBy(F.desc("id")).coalesce(1), 0.1, key=["crash"]).collect()}
    assert kept[0.1] < kept[0.4] and 0.3 < len(kept[0.4]) / 5000 < 0.5
    # all rows of a crash or none
    assert len(kept[0.1]) == sum(5000 // 700 + (k < 5000 % 700) for k in {i % 700 for i in kept[0.1]})
    assert sample(frame, 1.5, key=["crash"]).count() == sample(frame, None).count() == 5000


def star(x, y, r, n, rng):
    return [(x + r * (0.7 + 0.3 * rng.random()) * math.cos(2 * math.pi * k / n), y + r * (0.7 + 0.3 * rng.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def test_points_meet_few_edges_where_edges_are_dense(spark):
    """A ring of 20,000 edges within one old grid cell: cells stay small and answers equal the even-odd rule."""
    rng = random.Random(9)
    ring = star(-74.0, 40.7, 0.002, 20_000, rng)
    layer = spatial.Layer(spatial.polygon_table(spark, [("dense", ring), ("wide", star(-73.5, 41.2, 0.4, 40, rng))]))
    most = max(table.select(F.max(F.aggregate("shapes", F.lit(0), lambda n, s: n + F.size(s.edges)))).first()[0] for table, _ in layer.within.levels.values())
    assert most <= 48 and len(layer.within.levels) > 1
    pts = [(i, 40.7 + rng.uniform(-0.003, 0.003), -74.0 + rng.uniform(-0.003, 0.003)) for i in range(300)]
    df = spark.createDataFrame(pts, "i int, latitude double, longitude double")
    got = {r["i"]: r["polygon"] for r in spatial.point_in_polygon(df, layer).collect()}

    def inside(x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    assert got == {i: "dense" if inside(lo, la) else None for i, la, lo in pts}
    assert set(got.values()) == {"dense", None}


def test_indexed_searches_equal_scans(spark, tmp_path):
    pick = random.Random(6)
    texts = ["".join(pick.choice("abc dé😀") for _ in range(pick.randrange(0, 40))) for _ in range(400)] + [None, "", "ab", "needle in the hay", "NEEDLE", "x" * 5000]
    data = [(i, t, pick.choice(["north", "south", None]), 1990 + i % 9) for i, t in enumerate(texts)] + [(None, "needle without key", None, 1995), (7, "again a key, needle", "x", 2001)]
    df = spark.createDataFrame(data, "id long, text string, side string, year int")
    folder, cols = str(tmp_path / "grams"), ["text", "side", "missing"]
    textindex.build_index(df, "id", cols, folder, "year")
    for query in ("needle", "Needle I", "abc", "a b", "é😀", "😀d ", "ab", "", "north", "1995", "never there", "xxxxxxxxxxxx", None):
        got = sorted(rows(textindex.search_indexed(df, folder, query, "id", cols, "year")), key=str)
        assert got == sorted(rows(search(df, query, cols, "year")), key=str), query
    # few rows are nominated, and the look-up reaches the reader
    nominated = textindex.candidates(spark, folder, "needle")
    assert nominated.count() == 3 and "PushedFilters: [In(gram" in nominated._jdf.queryExecution().executedPlan().toString()
    assert textindex.candidates(spark, folder, "ab") is None and textindex.candidates(spark, folder, "north") is None
    assert textindex.candidates(spark, folder, "never there").count() == 0


def test_rows_of_one_key_are_all_found(spark, tmp_path):
    data = [(7, "the first needle"), (7, "a needle again"), (8, "need"), (8, "edle")] + [(100 + i, "hay") for i in range(50)]
    df = spark.createDataFrame(data, "id long, text string")
    textindex.build_index(df, "id", ["text"], str(tmp_path / "grams"))
    assert sorted(rows(textindex.search_indexed(df, str(tmp_path / "grams"), "needle", "id", ["text"]))) == [(7, "a needle again"), (7, "the first needle")]


@pytest.mark.parametrize("piece", [7, 1 << 21])
def test_postings_hold_each_gram_of_each_row_once_in_a_list(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(textindex, "PIECE", piece)
    pick = random.Random(piece)
    texts = ["".join(pick.choice("aB\u00e9\U0001f600 ") for _ in range(pick.randrange(0, 30))) for _ in range(300)] + ["".join(map(chr, range(0x4E00, 0x9E00)))]
    held = [(row, t) for part in textindex._pieces([texts, [None] * len(texts)]) for row, t in part]
    found = set()
    for part in textindex._pieces([texts]):
        grams, cuts, row = textindex._grams(part)
        assert grams == sorted(set(grams))
        pairs = [(g, int(r)) for g, a, b in zip(grams, cuts, cuts[1:]) for r in row[a:b]]
        assert len(pairs) == len(set(pairs))
        found.update(pairs)
    assert found == {(t[i : i + 3], r) for r, t in enumerate(texts) for i in range(len(t) - 2)} and all(len(t) <= piece + 2 for _, t in held)
    df = spark.createDataFrame([(i, "common words") for i in range(2000)], "id long, text string").coalesce(1)
    textindex.build_index(df, "id", ["text"], str(tmp_path / "grams"))
    postings = spark.read.parquet(f"{tmp_path}/grams/postings")
    assert postings.agg(F.sum("n")).first()[0] == 20000 and (piece == 7 or postings.count() == 10)


def test_pyramid_levels_are_sums_of_finer_ones(spark, tmp_path):
    pick = random.Random(2)
    data = [(pick.uniform(40.5, 40.9), pick.uniform(-74.2, -73.7), pick.randrange(4)) for _ in range(500)] + [(None, -74.0, 1), (95.0, -74.0, 1), (40.7, -74.0, None), (-90.0, -180.0, 2)]
    df = spark.createDataFrame(data, "latitude double, longitude double, severity_score int")
    folder = str(tmp_path / "pyramid")
    pyramid.build_pyramid(df, folder, 12)
    fine = [(la, lo, s or 0) for la, lo, s in data if la is not None and -90 <= la < 90]
    for level in (12, 9, 3, 0):
        want = {}
        for la, lo, s in fine:
            at = (int((lo + 180) / 360 * 2**level), int((la + 90) / 180 * 2**level))
            n, total = want.get(at, (0, 0))
            want[at] = (n + 1, total + s)
        stored = {(r["x"], r["y"]): (r["n"], r["severity"]) for r in spark.read.parquet(f"{folder}/level={level}").collect()}
        assert stored == want
        cells = pyramid.map_cells(spark, folder, level).collect()
        assert sum(r["n"] for r in cells) == len(fine) and all(abs(r["severity_mean"] - r["severity"] / r["n"]) < 1e-12 for r in cells)
    box = pyramid.map_cells(spark, folder, 12, (-74.0, 40.6, -73.9, 40.7)).collect()
    assert 0 < len(box) < spark.read.parquet(f"{folder}/level=12").count() and all(-74.1 < r["lon"] < -73.8 and 40.5 < r["lat"] < 40.8 for r in box)
    assert pyramid.level_for(360) == 8 and pyramid.level_for(1e-9) == pyramid.LEVEL


def test_quadkeys_interleave_bits(spark):
    df = spark.createDataFrame([(5, 3), (0, 0), (2**20 - 1, 0), (2**20 - 1, 2**20 - 1)], "x int, y int")
    want = [sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(20)) for x, y in rows(df)]
    assert [r[0] for r in df.select(pyramid.quadkey(F.col("x"), F.col("y"))).collect()] == want
