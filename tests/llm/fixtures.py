"""Small tables with the odd cases that every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators might use inside
    T.StructField("id", T.StringType()), T.StructField("rx", T.LongType()), T.StructField("key", T.StringType()),
])


def words(n: int, seed: int, vocabulary: int = 4000) -> list[str]:
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty, repeated, very long, shared passages, ties."""
    shared = " ".join(words(60, 1))
    long = " ".join(words(9000, 2))
    out: list[tuple] = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", "fr", None), (4, "one", None, "b"),
        (5, "Ünïcode 😀 line that repeats\nother\n\n  Ünïcode 😀 line that repeats  ", "en", "b"),
        (6, "Ünïcode 😀 line that repeats\nthis is its own", "en", "c"),
        (7, f"{long} {shared} {long[:3000]}", "en", "c"), (8, f"before {shared} after", "de", "a"), (9, f"x {shared}", "de", "a"),
        (9, f"x {shared}", "de", "a"), (None, f"null id {shared}", "de", None), (None, None, None, None),
        (10, "a b c d e f", "en", "a"), (11, "A B c D e F", "en", "a"), (12, "a b c d e g", "en", "a"),
        (13, "abcabcabc " * 120, "en", "a"), (14, "z" * 2500, "en", "b"), (-3, shared.upper(), "es", "b"),
    ]
    base = words(200, 5)
    for i in range(20):
        near = list(base)
        for j in range(i % 4):
            near[(37 * i + 50 * j) % 200] = f"changed{i}x{j}"
        out.append((100 + i, " ".join(near), "en", "hot"))
    return out


def table(spark, rows: list[tuple] | None = None):
    data = [(*r[:4], len(r[1]) if r[1] is not None else None, "clash", 7, None) for r in (odd_rows() if rows is None else rows)]
    return spark.createDataFrame(data, SCHEMA)


def sorted_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
