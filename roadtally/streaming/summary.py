"""Exploded summary over a stream of record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadtally.plans.derive import add_up, as_summary, explode_cells, summary_cells, with_basics
from roadtally.sources.readers import path_exists


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until the query has read everything; past the timeout it is stopped and an error is raised, as its output is not whole."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream was not done after {timeout_s} s; call again to go on from its checkpoint")


def live_summary(stream: DataFrame, style: str = "known", mode: str = "sum4") -> DataFrame:
    """The summary as one streaming aggregate, for `update` or `complete` output.

    Its state holds one row per summary cell.
    """
    base = with_basics(stream, mode)
    rows = base.select(
        "borough", "year", "_vehicles", "_factors", F.lit(1).cast("bigint").alias("n"),
        F.col("severity_score").alias("severity"), F.col("total_injured").alias("injured"), F.col("total_killed").alias("killed"),
    )
    return as_summary(add_up(explode_cells(rows, style)))


def write_partial(batch: DataFrame, batch_id: int, folder: str, style: str = "known", mode: str = "sum4") -> None:
    """Summed totals of one micro-batch in a folder of its own.

    A batch that is run again after a failure overwrites its own folder, so no
    row is counted twice.
    """
    cells = summary_cells(batch, style, mode)
    cells.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def stream_summary(
    stream: DataFrame,
    folder: str,
    checkpoint: str,
    style: str = "known",
    mode: str = "sum4",
    timeout_s: float | None = None,
) -> None:
    """Add all files that have arrived since the last call to the partial sums in `folder`."""
    query = (
        stream.writeStream.foreachBatch(lambda df, i: write_partial(df, i, folder, style, mode))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout_s)


def read_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary over all batches so far; means are taken at the end."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    return as_summary(add_up(spark.read.parquet(folder)))


def compact(spark: SparkSession, folder: str, into: str) -> None:
    """Partial sums of many batches as one small table with the same sums, under `into`."""
    add_up(spark.read.parquet(folder)).write.mode("errorifexists").parquet(f"{into}/batch_id=-1")
