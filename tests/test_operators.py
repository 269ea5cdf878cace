import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.operators import aggregates as ag
from roadtally.operators import columns as co
from roadtally.operators import filters as fl
from roadtally.operators import joins as jo
from roadtally.operators import quality, sets, spatial, stats, windows


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another third has no key."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        key = 7 if i % 3 == 0 else None if i % 3 == 1 else rng.randrange(100)
        data.append((i, key, f"v{i}" if rng.random() < 0.2 else None, rng.choice(["a", None])))
    return spark.createDataFrame(data, "id int, k int, v string, w string").repartition(5).cache()


def test_resolver(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "`POSITION IN VEHICLE` int, gender int, SUM_INJURED int, `x.crash_datetime_utc` int, lat int")
    assert co.resolve(df, "position_in_vehicle") == "POSITION IN VEHICLE"
    assert co.resolve(df, "person_sex") == "gender"
    assert co.resolve(df, "total_injured") == "SUM_INJURED"
    assert co.resolve(df, "crash_datetime") == "x.crash_datetime_utc"
    assert co.resolve(df, "latitude") == "lat"
    assert co.resolve(df, "nothing") == "nothing" and not co.has_role(df, "nothing")
    assert df.select(co.role_col(df, "crash_datetime")).first()[0] == 4
    assert co.rename_roles(df, ["latitude"]).columns[-1] == "latitude"


def test_defaults_totals_and_lists(spark):
    df = spark.createDataFrame(
        [("BROOKLYN", "2021-06-26 10:00:00", "1", "x", "['Sedan']", None), (None, "bad", "2", "1", "", "a; b")],
        "BOROUGH string, CRASH_DATETIME string, `NUMBER OF PERSONS INJURED` string, `NUMBER OF CYCLIST KILLED` string, "
        "ALL_VEHICLE_TYPES string, ALL_CONTRIBUTING_FACTORS string",
    )
    a, b = co.prepare_dashboard(df).collect()
    assert (a["borough"], a["year"], a["hour"], a["day_of_week"]) == ("Brooklyn", 2021, 10, "Saturday")
    assert (a["total_injured"], a["total_killed"], a["severity_score"]) == (1, 0, 1)
    assert (b["borough"], b["year"], b["total_killed"], b["severity_score"]) == ("Unknown", None, 1, 7)
    assert a["vehicle_types_list"] == ["Sedan"] and b["factors_list"] == ["a", "b"] and a["full_address"] == ", Brooklyn"
    assert a["person_type"] == "Unknown" and a["latitude"] is None
    assert co.with_totals(df, "persons").select("total_killed").first()[0] == 0
    with pytest.raises(KeyError):
        co.with_totals(df, "other")


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, None, None)], "a int, b string, c string")
    assert co.drop_sparse(df, 0.8).columns == ["a", "c"]
    assert co.null_rates(df)["c"] == pytest.approx(2 / 3)
    left, right = co.split_columns(df, ["a"])
    assert left.columns == ["a"] and right.columns == ["b", "c"]
    assert co.schema_diff(left.withColumn("b", F.lit(1)), right) == {"common": ["b"], "only_left": ["a"], "only_right": ["c"]}
    assert co.quoted("a`b") == "`a``b`"


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "Bronx", 2019, ["SUV", "Van"], ["['speeding'"], "F", "30"), (2, "brooklyn", 2020, [], ["glare"], "m", "x"), (3, None, 2021, None, None, None, None)],
        "id int, borough string, year int, vehicle_types_list array<string>, factors_list array<string>, person_sex string, person_age string",
    )

    def ids(test):
        return [r["id"] for r in df.where(test).orderBy("id").collect()]

    assert ids(fl.in_set("borough", [])) == [1, 2, 3] and ids(fl.in_set("borough", ["Bronx"])) == [1]
    assert ids(fl.in_set_ci("borough", ["BROOKLYN"])) == [2] and ids(fl.in_set_ci("borough", [""])) == [3]
    assert ids(fl.years_in("year", [2019, 2021])) == [1, 3]
    assert ids(fl.any_in("vehicle_types_list", ["Van"])) == [1] and ids(fl.any_in("vehicle_types_list", [])) == [1, 2, 3]
    assert ids(fl.any_like("factors_list", ["[speed"])) == [1] and ids(fl.any_like("factors_list", ["glare"])) == [2]
    assert ids(fl.in_text("borough", [""])) == [3]
    assert [r["id"] for r in fl.search(df, "BRO", ["borough"], "year").orderBy("id").collect()] == [1, 2]
    assert [r["id"] for r in fl.search(df, "2021", ["borough"], "year").collect()] == [3]
    chosen = fl.Filters(boroughs=("Bronx",), vehicles=("SUV",), factors=("speeding",), sexes=("f",), min_age=20, max_age=40, year_set=(2019,))
    assert [r["id"] for r in chosen.apply(df).collect()] == [1]
    assert fl.Filters().empty and not chosen.empty


def test_intersect_filters():
    saved = fl.Filters(boroughs=("Bronx", "Queens"), years=(2015, 2020))
    out = fl.intersect_filters(saved, {"boroughs": ["Queens"], "years": (2018, 2024), "vehicles": ["Van"]})
    assert out.boroughs == ("Queens",) and out.years == (2018, 2020) and out.vehicles == ("Van",)
    over = fl.intersect_filters(saved, {"boroughs": ["Manhattan"], "years": (2018, 2024)}, override=True)
    assert over.boroughs == ("Manhattan",) and over.years == (2018, 2024)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_year_between(spark, kind):
    df = spark.createDataFrame([("2018-12-31",), ("2019-01-01",), ("2020-12-31",), ("2021-01-01",), (None,)], "t string").withColumn("t", F.col("t").cast(kind))
    assert df.where(fl.year_between(df, "t", 2019, 2020)).count() == 2


def test_year_range_reaches_the_parquet_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2019-05-05' as ts, 1 as x").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(fl.year_between(df, "ts", 2019, 2020))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_samples(spark, skewed):
    got = fl.sample_n(skewed, 50, ["id"])
    assert got.count() == 50 and got.select("id").distinct().count() == 50
    other = fl.sample_n(skewed.repartition(3), 50, ["id"])
    assert rows(got.select("id")) == rows(other.select("id"))
    assert fl.sample_n(skewed, 5000, ["id"]).count() == 900
    assert fl.sample(skewed, None).count() == 900 and fl.sample(skewed, 0.5).count() < 900


def test_hot_keys_are_found(spark, skewed):
    hot = jo.hot_keys(skewed, "k", share=0.1, sample=1.0, min_hits=1)
    assert set(hot) == {7, None} and hot[7] > 0.33
    assert jo.hot_keys(skewed, "k") == {}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, skewed, how):
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 100, 3)] + [(7, "r7"), (7, "second")], "k int, r string")
    plain = skewed.join(right, "k", how)
    spread = jo.spread_join(skewed, right, "k", how, hot={7: 0.33, None: 0.33, 3: 0.01}, share=0.04)
    assert rows(spread.select(*plain.columns)) == rows(plain)


def test_spread_join_spreads_the_hot_key(spark, skewed):
    right = spark.createDataFrame([(7, "x")], "k int, r string")
    joined = jo.spread_join(skewed, right, "k", "left", hot={7: 0.33, None: 0.33}, share=0.02)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and joined.count() == 900


def test_lookup_join_small_and_large(spark, skewed):
    lookup = spark.createDataFrame([(k, k * 2) for k in range(100)], "k int, d int")
    want = rows(skewed.join(lookup, "k", "left"))
    assert rows(jo.lookup_join(skewed, lookup, "k")) == want
    assert rows(jo.lookup_join(skewed, lookup, "k", max_rows=3)) == want


def test_integrate_prefers_the_crash_time(spark):
    people = spark.createDataFrame([(1, 10, "2020-01-01 00:00:00", "p"), (2, 11, "2020-01-02 00:00:00", "p"), (3, None, None, "p")], "unique_id int, collision_id int, crash_datetime string, note string")
    crashes = spark.createDataFrame([(10, "2021-01-01 00:00:00", "c", "Bronx"), (12, None, "c", "Queens")], "collision_id int, crash_datetime string, note string, borough string")
    got = {r["unique_id"]: (str(r["crash_datetime"])[:10], r["note"], r["borough"]) for r in jo.integrate(people, crashes).collect()}
    assert got == {1: ("2021-01-01", "p", "Bronx"), 2: ("2020-01-02", "p", None), 3: ("None", "p", None)}


def test_small_joins(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("c", 5), (None, 6)], "k string, n int")
    assert rows(jo.keep_top(df, "k", 1)) == [("a", 1), ("a", 2)]
    assert rows(jo.unmapped(df, "k", ["a", "z"])) == [("b",), ("c",)]
    sizes = {r["n"]: r["group_size"] for r in jo.with_group_size(df, "k").collect()}
    assert sizes == {1: 2, 2: 2, 3: 1, 4: 2, 5: 2, 6: None}
    scaled = {r["n"]: r["s"] for r in jo.min_max_scale(df, "n", "s").collect()}
    assert scaled[1] == pytest.approx(10.0) and scaled[6] == pytest.approx(35.0)


def brute_fill(data, cols):
    out = {}
    groups = {}
    for r in sorted(data, key=lambda r: r["id"]):
        groups.setdefault(r["k"], []).append(r)
    for k, members in groups.items():
        for i, r in enumerate(members):
            filled = []
            for c in cols:
                before = [m[c] for m in members[: i + 1] if m[c] is not None]
                after = [m[c] for m in members[i:] if m[c] is not None]
                filled.append(r[c] if k is None else before[-1] if before else after[0] if after else None)
            out[r["id"]] = tuple(filled)
    return out


@pytest.mark.parametrize("chunk_rows", [10**6, 200, 40, 7])
@pytest.mark.parametrize("order", [["id"], ["half", "id"]])
def test_fill_within_equals_brute_force(spark, skewed, chunk_rows, order):
    """A group with a third of the rows, also in an order whose first column has two values."""
    data = skewed.withColumn("half", (F.col("id") > 450).cast("int"))
    want = brute_fill(skewed.collect(), ["v", "w"])
    got = windows.fill_within(data, "k", ["v", "w"], order, chunk_rows=chunk_rows)
    assert {r["id"]: (r["v"], r["w"]) for r in got.collect()} == want


def test_chunks_split_long_runs_of_equal_values(spark):
    df = spark.range(4000).withColumn("half", F.col("id") % 2)
    chunks = windows._in_chunks(df, [F.col("half"), F.col("id")], 200).groupBy("_chunk").count().collect()
    assert len(chunks) == 20 and max(r["count"] for r in chunks) <= 400


def test_dedupe_and_row_numbers(spark, skewed):
    first = windows.dedupe_first(skewed, ["k"], ["id"])
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: r["id"]):
        want.setdefault(r["k"], r["id"])
    assert {r["k"]: r["id"] for r in first.collect()} == want
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    numbered = windows.dense_row_number(skewed.where("id % 2 = 0"), ["id"], "n", chunk_rows=70)
    assert [r["n"] for r in numbered.orderBy("id").collect()] == list(range(1, 451))
    assert co.with_row_id(skewed).select("unique_id").distinct().count() == 900
    assert co.with_row_id(skewed, "u", ["id"]).agg(F.max("u")).first()[0] == 900


def test_lookup_fill_priority(spark):
    df = spark.createDataFrame([(1, "A", None, None), (2, "B", 5.0, 6.0), (3, "C", None, 1.0), (4, None, None, None)], "id int, a string, lat double, lon double")
    lookup = spark.createDataFrame(
        [(1, 1, "A", 10.0, None), (2, 1, "A", 11.0, 12.0), (3, 3, "C", None, 9.0), (4, None, "A", 20.0, 21.0), (5, None, "C", 30.0, 31.0)],
        "o int, id int, a string, la double, lo double",
    )
    keys = [("id", F.col("id"), F.col("id")), ("a", F.col("a"), F.col("a"))]
    cols = {"lat": "la", "lon": "lo"}
    got = {r["id"]: (r["lat"], r["lon"]) for r in jo.lookup_fill(df, lookup, keys, cols, "o").collect()}
    assert got == {1: (10.0, 12.0), 2: (5.0, 6.0), 3: (30.0, 1.0), 4: (None, None)}
    late = spark.createDataFrame([(1, 1, "x", 1.0, 1.0), (2, 9, "A", 2.0, 2.0)], "o int, id int, a string, la double, lo double")
    last = {r["id"]: r["lat"] for r in jo.lookup_fill(df, late, keys, cols, "o", later_wins=True).collect()}
    assert last[1] == 2.0


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", "x", "['S', 'S', 'T']", "f"), ("a", "y", "S, U", "f;g"), ("b", None, "", None), (None, "x", "['S', 'S', 'T']", "f")],
        "k string, d string, cars string, factors string",
    )
    assert [tuple(r) for r in ag.count_by(df, "k").collect()][0] == ("a", 2)
    assert rows(ag.count_by(df, ["k", "d"], keep_null=False)) == [("a", "x", 1), ("a", "y", 1)]
    assert rows(ag.count_labels(df, "cars", name="car")) == [("S", 5), ("T", 2), ("U", 1)]
    assert rows(ag.count_labels(df, "cars", name="car", style="known"))[-1] == ("Unknown", 1)
    assert [tuple(r) for r in ag.top_labels(df, "cars", 1).collect()] == [("S", 5)]
    assert rows(ag.pair_matrix(df, "cars", "factors")) == [("S", "f", 5), ("S", "g", 1), ("T", "f", 2), ("U", "f", 1), ("U", "g", 1)]
    assert rows(ag.value_counts(df, ["k", "d"])) == [("a", 2), ("b", 1), ("x", 2), ("y", 1)]
    wide = ag.pivot_top(df, "k", "d", None, 1)
    assert rows(wide) == [("a", 1), (None, 1)] and wide.columns == ["k", "x"]
    shares = {r["k"]: r["share"] for r in ag.share_by(df, "k").collect()}
    assert shares == {"a": 0.5, "b": 0.25, None: 0.25}
    arrays = df.withColumn("cars", F.split("cars", ","))
    assert ag.count_labels(arrays, "cars").count() > 0
    with pytest.raises(ValueError):
        ag.labels_of(df, "cars", "odd")


def test_time_series_fills_gaps(spark):
    df = spark.createDataFrame([("2021-01-31",), ("2021-04-01",), ("2021-04-02",), (None,)], "t string")
    got = [(r["period"].isoformat(), r["cnt"]) for r in ag.time_series(df, "t").collect()]
    assert got == [("2021-01-01", 1), ("2021-02-01", 0), ("2021-03-01", 0), ("2021-04-01", 2)]
    assert ag.time_series(df, "t", label="end").first()["period"].isoformat() == "2021-01-31"
    assert ag.time_series(df, "t", "Day").count() == 62 and ag.time_series(df, "t", "Year").first()["cnt"] == 3
    assert ag.time_series(df.where("false"), "t").count() == 0


def test_kpis_of_no_rows(spark):
    df = spark.createDataFrame([(1, 2)], "total_injured int, total_killed int").where("false")
    assert tuple(ag.kpis(df).first()) == (0, 0, 0, 0.0)


@pytest.mark.parametrize("buckets", [4, 16, 4096])
def test_exact_quantiles_equal_numpy(spark, buckets):
    rng = random.Random(1)
    data = [rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 5), 3.25]) for _ in range(2001)] + [None]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = stats.exact_quantiles(df, "v", qs, buckets)
    assert got == pytest.approx(np.quantile([v for v in data if v is not None], qs))


def test_quantiles_and_histogram_with_infinities(spark):
    inf = float("inf")
    data = [-inf] * 3 + [float(i) for i in range(10)] + [1e308, -1e308] + [inf] * 5 + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    clean = sorted(v for v in data if v is not None and v == v)
    got = stats.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0], 2)
    at = [q * (len(clean) - 1) for q in (0.0, 0.1, 0.5, 0.9, 1.0)]
    want = [clean[int(x)] if clean[int(x)] == clean[min(int(x) + 1, len(clean) - 1)] else clean[int(x)] + (clean[int(x) + 1] - clean[int(x)]) * (x - int(x)) for x in at]
    assert got == pytest.approx(want)
    small = spark.createDataFrame([(v,) for v in [-inf, 0.0, 1.0, 10.0, inf, inf]], "v double")
    assert [tuple(r) for r in stats.histogram(small, "v", 2).collect()] == [(-1, -inf, 0.0, 1), (0, 0.0, 5.0, 2), (1, 5.0, 10.0, 1), (2, 10.0, inf, 2)]


def test_quantiles_of_one_value_and_none(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert stats.exact_quantiles(df, "v", [0.5], 2) == [2.0]
    assert stats.exact_quantiles(df.where("false"), "v", [0.5]) == [None]
    assert stats.iqr_outliers(df.where("false"), "v").count() == 0
    assert stats.box_stats(df, "v").first()["median"] == 2.0
    assert [tuple(r) for r in stats.histogram(df, "v", 5).collect()] == [(0, 2.0, 2.0, 2)]


def test_imputation_and_modes(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (30.0,), (120.0,), (None,)], "age double")
    assert sorted(r[0] for r in stats.impute_mean(df, "age", 0, 120).collect()) == [10.0, 20.0, 20.0, 20.0, 30.0]
    people = spark.createDataFrame(
        [("h", "b"), ("h", "a"), ("h", None), ("h", "Unknown"), ("n", None), (None, None), (None, "x"), ("h", "Does Not Apply")], "g string, c string"
    )
    assert rows(stats.mode_by_group(people, "g", "c")) == [("h", "Does Not Apply"), ("n", None)]
    named = people.where("c is null or c not in ('Unknown', 'Does Not Apply')")
    assert rows(stats.fill_mode_by_group(named, "g", "c", ("Unknown",))) == [("h", "a"), ("h", "a"), ("h", "b"), ("n", None), (None, "Unknown"), (None, "x")]


def test_correlation_with_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double")
    got = {(r["col_x"], r["col_y"]): r["corr"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "c"] is None and got["a", "b"] == got["b", "a"]
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 7])[0, 1])
    assert stats.correlation_matrix(df, ["a", "c"], fill=0.0).where("corr is null").count() == 0


def test_hotspots(spark):
    rng = random.Random(2)
    data = [(40.0 + c + rng.random() / 100, -74.0 - c) for c in (0, 1, 2) for _ in range(60)] + [(None, 1.0)]
    data += [(40.0, -74.0)] * 40
    df = spark.createDataFrame(data, "latitude double, longitude double")
    got = stats.hotspots(df, k=3)
    sizes = {r["cluster"]: r["cluster_size"] for r in got.collect()}
    assert sum(sizes.values()) == 220 == got.agg(F.sum("points")).first()[0] and sorted(sizes.values()) == [60, 60, 100]
    assert stats.hotspots(df.limit(10)).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, None, "x"), (2, None, "x"), (3, "a", "x"), (3, "b", "x"), (None, "a", "y")], "k int, p string, q string")
    assert rows(quality.inconsistent(df, "k", ["p", "q"])) == [(1, False, True), (3, True, False)]
    assert rows(quality.rule_report(df, {"no p": F.col("p").isNull(), "null": F.col("q") == "zz"})) == [("no p", 2), ("null", 0)]


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, i int")
    assert rows(sets.concat([a, b])) == [(1, "x", None), (2, None, "y")]
    assert rows(sets.stack(spark.createDataFrame([("1", "2")], "p string, q string"), ["p", "q"])) == [("p", "1"), ("q", "2")]
    assert sets.distinct_rows(a.union(a)).count() == 1
    assert sets.tail(a.union(a.withColumn("i", F.lit(5))), 1, ["i"]).first()["i"] == 5


def ray(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def polygons(rng, n):
    shapes = []
    for i in range(n):
        cx, cy, k = rng.uniform(-74.2, -73.7), rng.uniform(40.5, 40.9), rng.randrange(3, 12)
        turn = sorted(rng.uniform(0, 2 * math.pi) for _ in range(k))
        shapes.append((f"p{i:02d}", [(cx + rng.uniform(0.01, 0.09) * math.cos(t), cy + rng.uniform(0.01, 0.09) * math.sin(t)) for t in turn]))
    return shapes


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_point_in_polygon_equals_brute_force(spark, limit):
    rng = random.Random(3)
    shapes = polygons(rng, 12)
    pts = [(i, rng.uniform(40.4, 41.0), rng.uniform(-74.3, -73.6)) for i in range(800)] + [(900, None, -74.0), (901, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "i int, latitude double, longitude double")
    layer = spatial.Layer(spatial.polygon_table(spark, shapes), max_edges=limit)
    got = {r["i"]: r["polygon"] for r in spatial.point_in_polygon(df, layer).collect()}
    want = {i: next((n for n, ring in shapes if la is not None and ray(ring, lo, la)), None) for i, la, lo in pts}
    assert got == want and layer.within.small == (limit > 0)


def mercator(lon, lat):
    return math.radians(lon) * 6378137.0, math.log(math.tan(math.radians(lat) / 2 + math.pi / 4)) * 6378137.0


def outline_distance(ring, x, y):
    best = math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        dx, dy = x2 - x1, y2 - y1
        t = min(1, max(0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x1 + t * dx - x, y1 + t * dy - y))
    return best


def test_locate_equals_brute_force(spark):
    rng = random.Random(4)
    shapes = polygons(rng, 10)
    pts = [(i, rng.uniform(40.4, 41.0), rng.uniform(-74.3, -73.6)) for i in range(500)] + [(900, None, None)]
    df = spark.createDataFrame(pts, "i int, latitude double, longitude double")
    got = {r["i"]: r["place"] for r in spatial.locate(df, spatial.polygon_table(spark, shapes), "place").collect()}
    flat = [(n, [mercator(*p) for p in ring]) for n, ring in shapes]
    for i, la, lo in pts:
        if la is None:
            assert got[i] is None
            continue
        held = next((n for n, ring in shapes if ray(ring, lo, la)), None)
        near = min((outline_distance(ring, *mercator(lo, la)), n) for n, ring in flat)
        assert got[i] == (held or (near[1] if near[0] <= 2000 else None))


def test_holes_parts_and_edges(spark):
    square, hole, part = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6)], [(20, 0), (22, 0), (22, 2), (20, 2)]
    layer = spatial.polygon_table(spark, [("a", square), ("a", hole), ("a", part), ("b", [(8, 8), (12, 8), (12, 12), (8, 12)])])
    pts = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 1.0, 21.0), (4, 9.0, 9.0), (5, 11.0, 11.0), (6, 0.0, 5.0), (7, 5.0, 4.0), (8, 1.0, 15.0)]
    df = spark.createDataFrame(pts, "i int, latitude double, longitude double")
    got = {r["i"]: r["polygon"] for r in spatial.point_in_polygon(df, layer).collect()}
    assert got == {1: "a", 2: None, 3: "a", 4: "a", 5: "b", 6: None, 7: None, 8: None}
