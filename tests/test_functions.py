import uuid

import pytest
from pyspark.sql import functions as F

from roadtally.functions import factors, ids, numbers, streets, tagging, temporal, text, vehicles


def values(spark, rows, build, kind="string"):
    """Apply a column function to one column of hand-written values, in order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "cell, want",
    [
        (None, []),
        ("", []),
        ("[]", []),
        ("['A']", ["A"]),
        ("['A', ' ']", ["A"]),
        ("A, B", ["A", "B"]),
        ("A;B", ["A", "B"]),
        ("A|B", ["A", "B"]),
        ("A;B, C", ["A;B", "C"]),
        ("123", []),
        ("1.5", []),
        ("None", []),
        ("True", []),
        ("'one'", []),
        ("'a', 'b'", ["a", "b"]),
        ("('a', 'b')", ["a", "b"]),
        ("('a',)", ["a"]),
        ("('a')", []),
        ("1, 2", ["1", "2"]),
        ("['A'", ["['A'"]),
        ("['A', 'B'", ["['A'", "'B'"]),
        ("['SUV/Station Wagon', 'Sedan']", ["SUV/Station Wagon", "Sedan"]),
        ('["O\'Neil", "x"]', ["O'Neil", "x"]),
        (" [ 'a' , 'b', ] ", ["a", "b"]),
        ("driver inattention", ["driver inattention"]),
        (",", [","]),
    ],
)
def test_parse_list(spark, cell, want):
    got = values(spark, [cell], text.parse_list)[0]
    assert got == want


def test_parse_list_is_idempotent_on_its_own_text(spark):
    cells = ["['a', 'b']", "x; y", "one", None]
    once = values(spark, cells, text.parse_list)
    again = values(spark, [str(v) for v in once], text.parse_list)
    assert once == again


def test_labels(spark):
    assert values(spark, ["['Sedan'", "SUV/Station  Wagon", "a-b & c, d!", None, "café (x)"], text.clean_label) == [
        "Sedan", "SUV/Station Wagon", "a-b & c, d", None, "café x",
    ]
    assert values(spark, ["['A', 'B!'], ,c", None], text.clean_list) == ["A,B,c", None]
    assert values(spark, [" A ", "Unknown", "", None], text.label) == ["A", "Unknown", "", "Unknown"]
    assert values(spark, [" A ", "", None], lambda c: text.label(c, "")) == ["A", "Unknown", "Unknown"]
    assert values(spark, ["[Lap Belt]", "", None], text.label_equipment) == ["lap belt", "Unknown", "Unknown"]
    assert values(spark, ["", None], lambda c: text.label_equipment(c, False)) == ["", ""]
    assert values(spark, ["BROOKLYN", " staten island ", None, ""], text.normalize_borough) == [
        "Brooklyn", "Staten Island", "Unknown", "Unknown",
    ]
    assert values(spark, ["a, b,,", None], lambda c: text.split_clean(c, False)) == [["a", "b", "", ""], [""]]
    assert values(spark, [["b", "a", "[a]", " "]], text.unique_labels, "array<string>") == [["a", "b"]]
    assert values(spark, ["\t x \n"], text.strip) == ["x"]


def test_injury_tests(spark):
    words = ["Injured", " no injury ", "None", "unknown", "", None, "Killed", "Fatality"]
    assert values(spark, words, text.is_injured) == [True, False, False, False, False, False, True, True]
    assert values(spark, words, text.is_fatal) == [False] * 6 + [True, True]


def test_numbers(spark):
    assert values(spark, ["12.7", "18.5", "19.5", "x", "", None, " 7 "], numbers.to_int) == [13, 19, 20, None, None, None, 7]
    assert values(spark, [38.5, 39.5, 12.7], numbers.to_int, "double") == [38, 40, 13]
    assert values(spark, ["3.0", "x", None], numbers.to_int0) == [3, 0, 0]
    ages = ["0", "-3", "18", "18.5", "19", "31", "51", "120", None, "x"]
    assert values(spark, ages, numbers.age_band) == ["0-18", "0-18", "0-18", "19-30", "19-30", "31-50", "51+", "51+", "Unknown", "Unknown"]
    assert values(spark, [1, 0], lambda c: numbers.rate(F.lit(1), c), "int") == [1.0, None]


def test_times(spark):
    days = values(spark, ["06/25/2021 4:05", "2021-06-26 10:00:00", "bad", None], temporal.try_ts)
    assert days[1].isoformat() == "2021-06-26T10:00:00" and days[2] is None and days[3] is None
    assert values(spark, ["2021-06-26", "2021-06-27", "2021-06-28", "bad", None], temporal.day_type) == [
        "Weekend", "Weekend", "Weekday", "Weekday", "Weekday",
    ]
    pair = spark.createDataFrame([("06/25/2021", "4:05"), ("bad", "4:05"), ("6/5/2021", "14:30"), (None, "1:00"), ("2021-06-25", "04:05:06")], "d string, t string")
    got = [r[0] and r[0].isoformat() for r in pair.select(temporal.combine_datetime("d", "t")).collect()]
    assert got == ["2021-06-25T04:05:00", None, "2021-06-05T14:30:00", None, "2021-06-25T04:05:06"]
    months = values(spark, ["2021-06-26 10:00:00"], lambda c: temporal.trunc_to(c, "Month"))
    assert months[0].isoformat() == "2021-06-01"
    assert values(spark, ["Sunday", "Monday", "x"], temporal.order_by_list) == [7, 1, 0]


def test_vehicles(spark):
    codes = [
        "PICK-UP TRUCK", "e-bike", "4 dr sedan", "station wagon/sport utility vehicle", None, "forklift", "Box Truck", "school bus",
        "livery car", "FDNY", "pedicab", "bike", "van",
    ]
    assert values(spark, codes, vehicles.classify_vehicle) == [
        "Pickup Truck", "Motorcycle", "Sedan", "SUV/Station Wagon", "Other", "Other", "Truck/Commercial", "Bus",
        "Taxi", "Ambulance", "Pedicab", "Bicycle", "Van",
    ]
    assert values(spark, ["Motorbike", "Passenger", "Truck", None], vehicles.vehicle_class) == ["Motorcycle", "Car", "Other", "Other"]
    df = spark.createDataFrame([("sedan", None, "4 dr"), ("forklift", "taxi", None)], "a string, b string, c string")
    plain = [r[0] for r in df.select(vehicles.vehicle_list(["a", "b", "c"])).collect()]
    other = [r[0] for r in df.select(vehicles.vehicle_list(["a", "b", "c"], null_as_other=True)).collect()]
    assert plain == [["Sedan"], ["Other", "Taxi"]]
    assert other == [["Sedan", "Other"], ["Taxi", "Other"]]


def test_streets(spark):
    names = ["E. 14 ST ", "5 AV N", "BED-STUY RD X", None, "a  st  st b"]
    assert values(spark, names, streets.clean_street) == ["E 14 ST", "5 AVENUE N", "BED STUY ROAD X", None, "A STREET ST B"]
    rows = [("ON", None, None), ("ON", "CROSS", None), (None, None, "OFF"), (None, "", None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert [r[0] for r in df.select(streets.build_address("a", "b", "c")).collect()] == [
        "ON, New York, NY", "ON, AND CROSS, New York, NY", "OFF, New York, NY", None, None,
    ]
    assert df.select(streets.fallback_address("a", "b")).first()[0] == "ON, "


def test_ids(spark):
    people = ["1982513", "123", "0000001", "a36d071f-550b-4fde-a34b-98e6326b5ecf", None]
    got = values(spark, people, ids.legacy_uuid)
    assert got[0] == "671f6765-4e62-554c-a966-fa61041a4102" == str(uuid.uuid5(uuid.NAMESPACE_DNS, "1982513"))
    assert got[1] == "123" and got[3:] == people[3:]
    many = [f"{n:07d}" for n in range(0, 5_000_000, 25_013)]
    assert values(spark, many, ids.legacy_uuid) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in many]
    assert values(spark, ["1", "12", None, "a"], ids.is_single_digit) == [True, False, False, False]


def test_factors(spark):
    assert values(spark, [" Unsafe Speed ", "80", "something else", None], factors.normalize_factor) == [
        "speeding", "unspecified", "something else", None,
    ]
    assert values(spark, ["Unsafe Speed", "Turning Improperly"], lambda c: factors.normalize_factor(c, "fine")) == ["unsafe speed", "turning improperly"]
    assert len(set(factors.FACTOR_LABELS.values())) == 27
    with pytest.raises(ValueError):
        factors.factor_labels("other")


def test_tagging(spark):
    texts = [
        "Injured female driver in Brooklyn between 2019 and 2015, SUV hit a station wagon",
        "m pedestrian killed by pickup truck, speeding, manhattan",
        "x2020 woman",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    a, b, c, d = tagging.tag_facets(df, "text").orderBy("i").collect()
    assert (a["years"], a["year_from"], a["year_to"], a["tag_borough"], a["tag_gender"]) == ([2015, 2019], 2015, 2019, "Brooklyn", "F")
    assert a["tag_vehicles"] == ["SUV/Station Wagon"] and a["tag_injuries"] == ["Injured"] and a["tag_person_types"] == ["Driver"]
    assert b["tag_gender"] == "M" and b["tag_vehicles"] == ["Pickup Truck", "Truck/Commercial"] and b["tag_factors"] == ["speeding"]
    assert c["years"] == [] and c["year_from"] is None and c["tag_gender"] == "F"
    assert d["tag_vehicles"] == [] and d["tag_borough"] is None
    whole = tagging.tag_facets(spark.createDataFrame([("manhattan",)], "text string"), "text", whole_words=True).first()
    assert whole["tag_gender"] is None
    assert tagging.tag_facets(spark.createDataFrame([("manhattan",)], "text string"), "text").first()["tag_gender"] == "M"
