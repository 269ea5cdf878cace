"""Map cells of all sizes from one stored table: each level's sums are those of the finer one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.operators.columns import has_role, role_col

#: Finest level: the world in 2**LEVEL columns and rows; a cell is about 38 m wide at the equator.
LEVEL = 20
SUMS = ("n", "severity")


def cell(lat: Column, lon: Column, level: int = LEVEL) -> tuple[Column, Column]:
    """Column and row of a point's cell; null outside the world."""
    def place(v: Column, low: float, width: float) -> Column:
        at = F.floor((v - F.lit(low)) / F.lit(width) * F.lit(float(1 << level)))
        return F.when((v >= low) & (v < low + width), at.cast("int"))

    return place(lon, -180.0, 360.0), place(lat, -90.0, 180.0)


def quadkey(x: Column, y: Column) -> Column:
    """The cell's place on the Z curve of its level: the bits of its column and row in turn."""
    def spread(v: Column) -> Column:
        v = v.cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def finest_cells(df: DataFrame, level: int = LEVEL) -> DataFrame:
    """x, y, n, severity of the located rows' cells; a row without severity adds 0. Counts combine before the shuffle."""
    lat, lon = role_col(df, "latitude").try_cast("double"), role_col(df, "longitude").try_cast("double")
    score = F.coalesce(role_col(df, "severity_score"), F.lit(0)) if has_role(df, "severity_score") else F.lit(0)
    x, y = cell(lat, lon, level)
    rows = df.select(x.alias("x"), y.alias("y"), score.cast("double").alias("severity")).where("x is not null and y is not null")
    return rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.sum("severity").alias("severity"))


def build_pyramid(df: DataFrame, folder: str, level: int = LEVEL, mode: str = "overwrite") -> None:
    """`level=`: x, y, n, severity for every level from `level` up to the whole world, each in the order of its Z curve.

    The table is read once; a coarser level is aggregated from the finer one
    that was written before it. Neighbours on the curve are neighbours on the
    map, so a box of the map meets few row groups.
    """
    spark = df.sparkSession
    cells = finest_cells(df, level)
    for at in range(level, -1, -1):
        path = f"{folder}/level={at}"
        key = quadkey(F.col("x"), F.col("y"))
        ordered = cells.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key").drop("key")
        ordered.write.mode(mode).parquet(path)
        finer = spark.read.parquet(path)
        half = [F.shiftright(c, 1).alias(c) for c in ("x", "y")]
        cells = finer.select(*half, *SUMS).groupBy("x", "y").agg(*[F.sum(c).alias(c) for c in SUMS])


def level_for(width: float, across: int = 256) -> int:
    """The level at which `width` degrees of longitude are about `across` cells."""
    level = 0
    while level < LEVEL and width / 360 * (1 << level) < across:
        level += 1
    return level


def map_cells(spark: SparkSession, folder: str, level: int, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """lat, lon (a cell's centre), n, severity, severity_mean of one level; `box` is west, south, east, north.

    Cells that the box touches are given whole. Means are exact: sums by counts.
    """
    cells = spark.read.parquet(f"{folder}/level={level}")
    if box:
        scale = float(1 << level)
        west, south, east, north = box
        cells = cells.where(F.col("x").between(int((west + 180) / 360 * scale), int((east + 180) / 360 * scale)))
        cells = cells.where(F.col("y").between(int((south + 90) / 180 * scale), int((north + 90) / 180 * scale)))
    size = 1 / float(1 << level)
    return cells.select(
        ((F.col("y") + 0.5) * F.lit(180 * size) - 90).alias("lat"), ((F.col("x") + 0.5) * F.lit(360 * size) - 180).alias("lon"),
        "n", "severity", (F.col("severity") / F.col("n")).alias("severity_mean"))
