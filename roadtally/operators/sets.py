"""Union of drifting schemas, stacking and previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.operators.columns import quoted


def concat(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack(df: DataFrame, cols: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per (row, column)."""
    return df.select([quoted(c) for c in cols]).unpivot([], cols, name, value)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*[quoted(o) for o in order]).limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(quoted(o)).desc() for o in order]).limit(n)
