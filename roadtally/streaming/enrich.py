"""Resumable geocode enrichment of crash files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadtally.plans.crashes import fill_coordinates
from roadtally.streaming.summary import finish


def enrich_batch(batch: DataFrame, batch_id: int, geocodes: DataFrame, folder: str, order: str = "batch", row_id: str | None = None) -> None:
    """Fill one batch's coordinates from the lookup; a repeated batch overwrites its own folder."""
    filled = fill_coordinates(batch, geocodes, order, row_id=row_id)
    filled.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def enrich_stream(
    stream: DataFrame,
    geocodes: DataFrame,
    folder: str,
    checkpoint: str,
    order: str = "batch",
    row_id: str | None = None,
    timeout_s: float | None = None,
) -> None:
    """Enrich the files that arrived since the last call; the checkpoint remembers the progress."""
    query = (
        stream.writeStream.foreachBatch(lambda df, i: enrich_batch(df, i, geocodes, folder, order, row_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout_s)
