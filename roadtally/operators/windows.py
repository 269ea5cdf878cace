"""Ordered operators that split a large group instead of giving it to one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadtally.operators.columns import quoted
from roadtally.session import written

# Rows of a chunk that one task puts in order.
CHUNK_ROWS = 1_000_000


def _in_chunks(df: DataFrame, order: list[Column], chunk_rows: int) -> DataFrame:
    """The rows with `_chunk`: chunks follow each other in `order` and are about equally large.

    The cuts are a range partitioning along all order columns, so a long run of
    equal values in the first ones is cut as well. The rows are written to the
    shared folder first, so that what makes them runs once, and again in their
    chunks, which are then fixed however often they are read.
    """
    rows = written(df, "rows")
    n = math.ceil(rows.count() / chunk_rows)
    if n <= 1:
        return rows.withColumn("_chunk", F.lit(0))
    return written(rows.repartitionByRange(n, *order).withColumn("_chunk", F.spark_partition_id()), "chunks")


def fill_within(df: DataFrame, key: str, cols: list[str], order: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Forward fill, then backward fill, within rows of the same key in `order`.

    Rows with a null key are groups of their own and stay as they are. The
    table is cut into chunks along key and order, so a large group spans
    several chunks; each is filled by itself. A chunk shares groups with its
    neighbours through its first and its last key only, so the values that must
    cross a border travel in a table of two rows per chunk at most.
    """
    by_order = [F.col(quoted(o)) for o in order]
    own, no_key = F.col(quoted(key)), F.col(quoted(key)).isNull()
    parted = _in_chunks(df, [own, *by_order], chunk_rows)

    # Only rows ahead of the part's first value need that value, so its frame is
    # the whole part; a frame from the row onwards would be read anew for every row.
    w = Window.partitionBy("_chunk", quoted(key)).orderBy(*by_order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A window of rows without a key is a row's own: nothing is filled there, and they are no group.
    keyed, lone = parted.where(~no_key), parted.where(no_key)
    steps = {f"_back_{i}": F.last(quoted(c), True).over(back) for i, c in enumerate(cols)}
    steps |= {f"_start_{i}": F.first(quoted(c), True).over(whole) for i, c in enumerate(cols)}
    out = keyed.withColumns(steps).join(F.broadcast(_carried(keyed, key, cols, by_order)), ["_chunk", key], "left")
    filled = {c: F.coalesce(*[F.col(f"{s}_{i}") for s in ("_back", "_before", "_start", "_after")]) for i, c in enumerate(cols)}
    names = [quoted(c) for c in df.columns]
    return out.withColumns(filled).select(*names).unionByName(lone.select(*names))


def _carried(chunked: DataFrame, key: str, cols: list[str], by_order: list[Column]) -> DataFrame:
    """Of keys that lie at a chunk's border: the last value before each of their chunks and the first one after it."""
    rank = F.struct(*by_order)
    edges = chunked.groupBy("_chunk").agg(F.min(quoted(key)).alias("_lo"), F.max(quoted(key)).alias("_hi"))
    # At most two keys per chunk.
    border = edges.select(F.explode(F.array("_lo", "_hi")).alias(key)).distinct()
    cut = chunked.join(F.broadcast(border), key, "left_semi")
    ends = cut.groupBy(quoted(key), "_chunk").agg(
        *[F.max_by(quoted(c), F.when(F.col(quoted(c)).isNotNull(), rank)).alias(f"_end_{i}") for i, c in enumerate(cols)],
        *[F.min_by(quoted(c), F.when(F.col(quoted(c)).isNotNull(), rank)).alias(f"_first_{i}") for i, c in enumerate(cols)],
    )
    before = Window.partitionBy(quoted(key)).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(quoted(key)).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        quoted(key),
        "_chunk",
        *[F.last(f"_end_{i}", True).over(before).alias(f"_before_{i}") for i in range(len(cols))],
        *[F.last(f"_first_{i}", True).over(after).alias(f"_after_{i}") for i in range(len(cols))],
    )


def dedupe_first(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in `order`; null keys are equal to each other.

    Spark keeps one row per key and task ahead of the shuffle (window group
    limit), so a key with many copies does not travel.
    """
    w = Window.partitionBy(*[quoted(k) for k in key]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") == 1).drop("_place")


def dense_row_number(df: DataFrame, order: list[str], name: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """1, 2, 3, ... in `order`.

    The rows are cut into chunks along the whole order; the numbers of a chunk
    start after the rows of the chunks before it.
    """
    by = [F.col(quoted(o)) for o in order]
    chunked = _in_chunks(df, by, chunk_rows)
    sizes = chunked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk.
    starts = sizes.select("_chunk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_chunk").orderBy(*by))
    numbered = chunked.withColumn("_place", place).join(F.broadcast(starts), "_chunk")
    return numbered.withColumn(name, F.col("_place") + F.col("_start")).drop("_chunk", "_place", "_start")
