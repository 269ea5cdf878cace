"""A summary that takes corrections and deletions: deltas merged by key and version into stored sums."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.operators.columns import quoted
from roadtally.plans.derive import TOTALS, add_up, as_summary, explode_cells, with_basics
from roadtally.session import written
from roadtally.sources.readers import path_exists
from roadtally.streaming.summary import finish

#: Parts of the stored rows; a batch reads only the parts that hold its keys.
BUCKETS = 64
#: Batches besides a whole one that a part's rows may lie in before it is written whole again.
DELTAS = 8
ROW = ["borough", "year", "_vehicles", "_factors", *TOTALS]


def _newest(batch: DataFrame, key: str, version: str, deleted: str | None, mode: str, buckets: int) -> DataFrame:
    """_key, _version, _gone, _bucket and what a row adds to the summary: the last version of each key of a batch.

    Rows without key take no part. Of equal versions a deletion wins, then the
    row whose columns have the largest hash, so that any order gives the same.
    """
    base = with_basics(batch.where(F.col(quoted(key)).isNotNull()), mode)
    gone = F.coalesce(F.col(quoted(deleted)).cast("boolean"), F.lit(False)) if deleted else F.lit(False)
    row = F.struct(
        "borough", "year", "_vehicles", "_factors",
        F.lit(1).cast("bigint").alias("n"), F.col("severity_score").cast("bigint").alias("severity"),
        F.col("total_injured").cast("bigint").alias("injured"), F.col("total_killed").cast("bigint").alias("killed"))
    rows = base.select(
        F.col(quoted(key)).cast("string").alias("_key"), F.col(quoted(version)).cast("bigint").alias("_version"), gone.alias("_gone"), row.alias("row"))
    rank = F.struct(F.coalesce("_version", F.lit(-(1 << 63))), "_gone", F.xxhash64("row"))
    best = rows.groupBy("_key").agg(F.max_by(F.struct("_version", "_gone", "row"), rank).alias("best"))
    return best.select(
        "_key", F.coalesce("best._version", F.lit(-(1 << 63))).alias("_version"), F.col("best._gone").alias("_gone"),
        F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("_bucket"), "best.row.*")


def _holders(spark: SparkSession, folder: str, before: int) -> dict[int, list[int]]:
    """Bucket -> the batches that hold its rows, from the last that wrote it whole, as of the batch before `before`; at most DELTAS + 1 a bucket."""
    if not path_exists(spark, f"{folder}/manifest"):
        return {}
    # entries of a ledger without the mark stand for whole buckets
    known = spark.read.schema("bucket int, whole boolean, batch_id long").parquet(f"{folder}/manifest").where(F.col("batch_id") < before)
    first = known.groupBy("bucket").agg(F.max(F.when(F.coalesce("whole", F.lit(True)), F.col("batch_id"))).alias("first"))
    found: dict[int, list[int]] = {}
    for r in known.join(first, "bucket").where("batch_id >= first").select("bucket", "batch_id").distinct().orderBy("batch_id").collect():
        found.setdefault(r["bucket"], []).append(r["batch_id"])
    return found


def _stored_rows(spark: SparkSession, folder: str, held: dict[int, list[int]], schema: T.StructType) -> DataFrame:
    """All stored versions in the held buckets; the partitions of others are not read."""
    paths = [f"{folder}/rows/batch_id={i}" for i in sorted({i for ids in held.values() for i in ids})]
    since: dict[int, list[int]] = {}
    for bucket, ids in held.items():
        since.setdefault(ids[0], []).append(bucket)
    kept = reduce(or_, [(F.col("batch_id") >= first) & F.col("_bucket").isin(buckets) for first, buckets in since.items()])
    return spark.read.schema(schema).option("basePath", f"{folder}/rows").parquet(*paths).where(kept).drop("batch_id")


def _last(rows: DataFrame, version: str) -> DataFrame:
    """The row of the largest version of each key; versions of a key differ."""
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.desc_nulls_last(version)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def merge_batch(
    batch: DataFrame, batch_id: int, folder: str, key: str, version: str, deleted: str | None = None, style: str = "known", mode: str = "sum4",
    buckets: int = BUCKETS,
) -> None:
    """Merge a batch of new, corrected and deleted rows into the stored rows and sums of `folder`.

    A row counts if its version is above the stored one of its key; deletions
    are kept as versions, so that an older row that comes late changes nothing.
    What the key added before is taken off the sums, what it adds now is put
    on: each batch writes signed sums of its own (`sums/batch_id=`), the rows
    that won (`rows/batch_id=/_bucket=`) and which buckets it touched
    (`manifest/batch_id=`). A batch reads only what batches before it wrote
    and overwrites its own folders, so a batch that is run again, after a
    failure or by mistake, leaves the same sums. The manifest comes last.

    Buckets are fixed with the first batch. A batch is shuffled by key; stored
    rows of untouched buckets are not read. A touched bucket whose rows lie in
    more than DELTAS batches is written whole again, so that later batches
    read it from one.
    """
    spark = batch.sparkSession
    new = written(_newest(batch, key, version, deleted, mode, buckets), "newest")
    touched = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]
    holders = _holders(spark, folder, batch_id)
    held = {b: holders[b] for b in touched if b in holders}
    whole = [b for b, ids in held.items() if len(ids) > DELTAS]
    columns = ["_key", "_version", "_gone", *ROW, "_bucket"]
    if held:
        old = _stored_rows(spark, folder, held, new.select(*columns).schema.add("batch_id", "long"))
        then = old.select("_key", F.col("_version").alias("_stored"), F.col("_gone").alias("_was_gone"), F.struct(*ROW).alias("_then"))
        met = new.join(then, "_key", "left")
        met = _last(met, "_stored") if any(len(ids) > 1 for ids in held.values()) else met
        met = written(met.where(F.col("_stored").isNull() | (F.col("_version") > F.col("_stored"))), "winners")
        off = met.where("_stored is not null and not _was_gone").select("_then.*").withColumns({t: -F.col(t) for t in TOTALS})
    else:
        met, off = new, new.select(*ROW).limit(0)

    on = met.where("not _gone").select(*ROW)
    texts = off.unionByName(on).groupBy("borough", "year", "_vehicles", "_factors").agg(*[F.sum(t).alias(t) for t in TOTALS])
    moved = texts.where(" or ".join(f"{t} <> 0" for t in TOTALS))
    add_up(explode_cells(moved, style)).write.mode("overwrite").parquet(f"{folder}/sums/batch_id={batch_id}")

    rows = met.select(*columns)
    if whole:
        stays = _last(old.where(F.col("_bucket").isin(whole)).select(*columns), "_version").join(met.select("_key"), "_key", "left_anti")
        rows = stays.select(*columns).unionByName(rows)
    # a bucket's rows meet in few tasks, so that a batch leaves few files
    rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}/rows/batch_id={batch_id}")
    entries = spark.createDataFrame([(b, b in whole or b not in held) for b in touched], "bucket int, whole boolean")
    entries.write.mode("overwrite").parquet(f"{folder}/manifest/batch_id={batch_id}")


def stream_corrections(
    stream: DataFrame, folder: str, checkpoint: str, key: str, version: str, deleted: str | None = None, style: str = "known", mode: str = "sum4",
    timeout_s: float | None = None, buckets: int = BUCKETS,
) -> None:
    """Merge all files that have arrived since the last call, batch by batch."""
    query = (
        stream.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, folder, key, version, deleted, style, mode, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout_s)


def corrected_cells(spark: SparkSession, folder: str, as_of: int | None = None) -> DataFrame:
    """Summed totals over all batches, or those up to `as_of`; cells that nothing is left of are gone."""
    sums = spark.read.parquet(f"{folder}/sums")
    return add_up(sums if as_of is None else sums.where(F.col("batch_id") <= as_of)).where("n <> 0")


def corrected_summary(spark: SparkSession, folder: str, as_of: int | None = None) -> DataFrame:
    """The exploded summary as if only the last version of each key had ever come."""
    return as_summary(corrected_cells(spark, folder, as_of))
