"""Facets named in free text: years, boroughs, vehicles, people, injuries, factors."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keyword -> facet value, in the order they are tried.
BOROUGH_WORDS = {
    "manhattan": "Manhattan",
    "brooklyn": "Brooklyn",
    "queens": "Queens",
    "bronx": "Bronx",
    "staten": "Staten Island",
    "staten island": "Staten Island",
}
VEHICLE_WORDS = {
    "suv": "SUV/Station Wagon",
    "station wagon": "SUV/Station Wagon",
    "sedan": "Sedan",
    "bicycle": "Bicycle",
    "bike": "Bicycle",
    "ambulance": "Ambulance",
    "bus": "Bus",
    "motorcycle": "Motorcycle",
    "pickup": "Pickup Truck",
    "pickup truck": "Pickup Truck",
    "taxi": "Taxi",
    "truck": "Truck/Commercial",
    "commercial": "Truck/Commercial",
    "van": "Van",
    "pedicab": "Pedicab",
}
PERSON_WORDS = {
    "pedestrian": "Pedestrian",
    "cyclist": "Bicyclist",
    "bicyclist": "Bicyclist",
    "motorist": "Motorist",
    "driver": "Driver",
    "occupant": "Occupant",
}
INJURY_WORDS = {
    "injured": "Injured",
    "injury": "Injured",
    "killed": "Killed",
    "fatal": "Killed",
    "fatality": "Killed",
    "death": "Killed",
    "died": "Killed",
    "unspecified": "Unspecified",
}
FACTOR_WORDS = {
    "tailgating": "tailgating",
    "unsafe": "unsafe maneuver",
    "failure to yield": "failure to yield",
    "vehicle defect": "vehicle defect",
    "traffic violation": "traffic violation",
    "speeding": "speeding",
    "visibility": "visibility issue",
    "substance": "substance impairment",
    "slippery": "slippery pavement",
    "pedestrian error": "pedestrian or bicyclist error",
    "bicyclist error": "pedestrian or bicyclist error",
    "passenger distraction": "passenger distraction",
    "fatigue": "driver fatigue",
    "driver inattention": "driver inattention",
    "driver inexperience": "driver inexperience",
    "conscious": "Apparent Death",
    "unconscious": "Apparent Death",
}
FEMALE_WORDS = ("female", "woman", "women")
MALE_WORDS = ("male", "man", "men")
# A stand-alone year 20xx. The literal comes first, so that the search can skip to it.
YEAR_PATTERN = r"(?U)(20(?<=(?<!\w)20)\d{2})(?!\w)"


def _has(text: Column, word: str, whole_words: bool) -> Column:
    return text.rlike(rf"(?U)\b{re.escape(word)}\b") if whole_words else text.contains(word)


def _needed(words: dict[str, str], whole: bool) -> dict[str, str]:
    """The words without those that contain an earlier word of the same value."""
    kept: dict[str, str] = {}
    for w, v in words.items():
        if whole or not any(o in w and kept[o] == v for o in kept):
            kept[w] = v
    return kept


def _all_hits(text: Column, words: dict[str, str], whole: bool) -> Column:
    hits = F.array(*[F.when(_has(text, w, whole), F.lit(v)) for w, v in _needed(words, whole).items()])
    return F.array_distinct(F.array_compact(hits))


def _first_hit(text: Column, words: dict[str, str], whole: bool) -> Column:
    return F.coalesce(*[F.when(_has(text, w, whole), F.lit(v)) for w, v in _needed(words, whole).items()])


def _gender(text: Column, whole: bool) -> Column:
    """A stand-alone letter decides before the words do; female words before male ones."""
    spaced = F.concat(F.lit(" "), text, F.lit(" "))
    female = F.lit(False)
    male = F.lit(False)
    for w in FEMALE_WORDS:
        female = female | _has(text, w, whole)
    for w in MALE_WORDS:
        male = male | _has(text, w, whole)
    return (
        F.when(spaced.contains(" f "), "F")
        .when(spaced.contains(" m "), "M")
        .when(female, "F")
        .when(male, "M")
    )


def tag_facets(df: DataFrame, text_col: str, whole_words: bool = False) -> DataFrame:
    """Add one column per facet found in the whole text.

    `years` is the sorted array of years named, `year_from`/`year_to` their
    range. Plain containment is the default; `whole_words` keeps 'man' out of
    'manhattan'. The result's columns are values for the filters of
    `roadtally.operators.filters`.
    """
    low = "_low_text"
    text = F.col(low)
    found = F.when(text.contains("20"), F.regexp_extract_all(text, F.lit(YEAR_PATTERN), F.lit(1)))
    years = F.array_sort(F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda y: y.cast("int")))
    tagged = df.withColumn(low, F.lower(F.trim(F.coalesce(F.col(text_col), F.lit(""))))).withColumns(
        {
            "years": years,
            "tag_borough": _first_hit(text, BOROUGH_WORDS, whole_words),
            "tag_vehicles": _all_hits(text, VEHICLE_WORDS, whole_words),
            "tag_person_types": _all_hits(text, PERSON_WORDS, whole_words),
            "tag_gender": _gender(text, whole_words),
            "tag_injuries": _all_hits(text, INJURY_WORDS, whole_words),
            "tag_factors": _all_hits(text, FACTOR_WORDS, whole_words),
        }
    )
    return tagged.withColumns(
        {
            "year_from": F.try_element_at("years", F.lit(1)),
            "year_to": F.try_element_at("years", F.lit(-1)),
        }
    ).drop(low)
