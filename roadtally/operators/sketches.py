"""Distinct counts that roll up: mergeable sketches beside exact counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.operators.columns import quoted
from roadtally.plans.derive import SUMMARY_KEYS, explode_cells, with_basics

#: log2 of a sketch's buckets. Its relative standard error is about 1.04 / sqrt(2**LG): 1.6 % at 12.
LG = 12


def standard_error(lg: int = LG) -> float:
    """Relative standard error of an estimate; a count is within three of them in 99.7 % of cases."""
    return 1.04 / (1 << lg) ** 0.5


def distinct_sketches(df: DataFrame, key: str, by: list[str], lg: int = LG) -> DataFrame:
    """by..., sketch: a HyperLogLog sketch of the different values of `key` in each group; null is no value.

    Sketches of parts of a table are what a sketch of the whole table would be
    once they are merged, so they can be stored by day or by cell and rolled up.
    """
    value = F.col(quoted(key)).cast("string")
    return df.groupBy(*[quoted(c) for c in by]).agg(F.hll_sketch_agg(value, F.lit(lg)).alias("sketch"))


def rolled_up(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by..., sketch: sketches of finer groups merged."""
    return sketches.groupBy(*[quoted(c) for c in by]).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct_about") -> DataFrame:
    """The sketches' estimates in place of the sketches."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def summary_sketches(merged: DataFrame, key: str = "collision_id", style: str = "known", mode: str = "sum4", lg: int = LG) -> DataFrame:
    """The keys of the exploded summary, each with a sketch of the crashes that its cell counts.

    A crash is in one cell for each pair of vehicle and factor, so sums of a
    summary's counts count it often; merged sketches count it once, under any
    filter on the summary's keys. Equal list texts are sketched before they are
    parsed and exploded, as in the summary.
    """
    base = with_basics(merged, mode).withColumn("_crash", F.col(quoted(key)).cast("string"))
    texts = base.where(F.col("_crash").isNotNull()).groupBy("borough", "year", "_vehicles", "_factors").agg(F.hll_sketch_agg("_crash", F.lit(lg)).alias("sketch"))
    return rolled_up(explode_cells(texts, style, ["sketch"]), SUMMARY_KEYS)


def distinct_crashes(sketches: DataFrame, by: list[str], lg: int = LG) -> DataFrame:
    """by..., crashes_about, at_least, at_most: different crashes of the merged cells, with three standard errors to both sides."""
    out = estimated(rolled_up(sketches, by), "crashes_about")
    margin = F.ceil(F.col("crashes_about") * (3 * standard_error(lg)))
    return out.withColumns({"at_least": F.col("crashes_about") - margin, "at_most": F.col("crashes_about") + margin})
