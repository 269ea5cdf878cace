"""Mixing sources to target weights along a curriculum; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import WORD, staged

#: Documents of a piece of a source, within which they are summed in order.
PIECE = 20_000
_IN = "__mix_"


@dataclass(frozen=True)
class Curriculum:
    """What is mixed. Sources by code point, null last, get `weights` in turn; all targets are `factor` of all words.

    No source is taken more than `epochs` times. `tilts`, in turn like the
    weights, say when a source is used: its share of the training is
    1 + tilt * (2 t - 1) at time t of 0..1, so a positive tilt is late.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    factor: float = 1.5
    epochs: int = 2
    tilts: tuple[float, ...] = (-0.5, 0.0, 0.5)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _in_turn(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (place % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, plan: Curriculum) -> DataFrame:
    """`s` (source), `source_size`, `target`, `tilt` of each source, from its sizes.

    Shares by weight stop at `epochs` times a source's size and what they
    leave is shared again. In order of size per weight, the sources before
    some place are full and all after it get one level per weight: the level
    is what is left of the whole over the weights left, at the first place
    where it fits.
    """
    by_name = Window.orderBy(F.col("s").isNull(), F.col("s").cast("binary"))
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy()
    upto = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", _in_turn(plan.weights, F.col("place")).cast("double")).withColumn("tilt", _in_turn(plan.tilts, F.col("place")))
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * plan.epochs)
    rows = rows.withColumn("all", F.sum("source_size").over(everything) * plan.factor).withColumn("weights", F.sum("weight").over(everything))
    rows = rows.withColumn("full", F.coalesce(F.sum("cap").over(upto), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    rows = rows.withColumn("level", (F.col("all") - F.col("full")) / (F.col("weights") - F.col("gone")))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)["level"]
    rows = rows.withColumn("final", level)
    return rows.select("s", "source_size", F.least("cap", F.coalesce(F.col("final") * F.col("weight"), "cap")).alias("target"), "tilt")


def training_time(share: Column, tilt: Column) -> Column:
    """When a source has used this share of its target: the inverse of its integrated weight, (1 - tilt) t + tilt t**2."""
    root = F.sqrt(F.greatest((1 - tilt) * (1 - tilt) + 4 * tilt * share, F.lit(0.0)))
    return F.when(tilt == 0, share).otherwise((root - (1 - tilt)) / (2 * tilt))


def planned(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, and what `mix` needs: all rows of `docs`, without their texts.

    Within a source, documents stand in the order of the md5 of their id. A
    document's words are taken once for each pass that reaches them: the part
    of [start, start + size) below the target, and below what the target
    leaves for later passes. So a source's words add up to its target, rounded
    down, and only one document a source is taken in part.

    Starts are sums over pieces of about PIECE documents, cut by the md5, so
    no task orders a whole source.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("s"), n_words(F.col(text_col)).alias("size"),
        F.md5(F.col(id_col).cast("string").cast("binary")).alias("m"), F.xxhash64(text_col).alias("rx"))
    rows = staged(spark, rows.withColumn("m", F.coalesce("m", F.lit(""))), "sizes")
    sizes = rows.groupBy("s").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    goals = staged(spark, targets(sizes.select("s", "source_size"), plan).join(
        sizes.select(F.col("s").alias("s2"), "docs"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2"), "targets")
    goals = goals.withColumn("pieces", F.ceil(F.col("docs") / PIECE)).withColumnRenamed("s", "goal")
    # of the md5 the first 8 hex digits, a number below 2**32
    head = F.coalesce(F.conv(F.substring("m", 1, 8), 16, 10).cast("long"), F.lit(0))
    placed = rows.join(goals, F.col("s").eqNullSafe(F.col("goal"))).withColumn("piece", F.floor(head * F.col("pieces") / F.lit(1 << 32)))
    before = Window.partitionBy("ps").orderBy("pp").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(F.col("s").alias("ps"), F.col("piece").alias("pp")).agg(F.sum("size").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("s", "piece").orderBy("m", F.col("doc_id").isNull(), "doc_id", "rx").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("s").eqNullSafe(F.col("ps")) & (F.col("piece") == F.col("pp")))
    placed = placed.withColumn("start", F.col("base") + F.col("inside"))
    goal = F.floor("target")
    passes = [F.greatest(F.lit(0), F.least("size", goal - e * F.col("source_size") - F.col("start"))) for e in range(plan.epochs)]
    parts = F.array(*passes)
    return placed.withColumn("passes", parts).select(
        "doc_id", "rx", "size", "source_size", "target", F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), "passes", "start", "tilt")


def _positions(rows: DataFrame) -> DataFrame:
    """One row for each pass that takes words of a document, with its training position of 0..1 and the words it takes."""
    each = rows.select("*", F.posexplode("passes").alias("pass", "words")).where("words > 0")
    share = F.try_divide(F.col("start") + F.col("pass") * F.col("source_size"), "target")
    return each.withColumn("position", training_time(share, F.col("tilt")))


def mixed_counts(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, position of every document, in ranges of its first training position.

    Null or empty text: size 0, nothing taken, no position; such rows come
    last. A null source is a source of its own, the last. Rows of one doc_id
    are documents of their own; equal rows are interchangeable. Without any
    word all targets are 0. Empty table: no rows.
    """
    rows = planned(docs, plan, id_col, text_col, source_col)
    position = F.when(F.col("taken") > 0, training_time(F.try_divide("start", "target"), F.col("tilt")))
    rows = rows.select("doc_id", "size", "source_size", "target", "taken", position.alias("position"))
    last = F.coalesce("position", F.lit(2.0)).alias("last")
    return rows.repartitionByRange(last).sortWithinPartitions(last, "doc_id")


def mix(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of `docs` in training order, one for each pass that takes words of a document.

    All columns are kept. A document that a source's target cuts comes with
    its leading words only. Rows without words are in no mix.
    """
    def nth(rows: DataFrame, id_: str, rx: str) -> DataFrame:
        """Rows of one id and text are told apart by a number."""
        return rows.withColumn(f"{_IN}nth", F.row_number().over(Window.partitionBy(id_, rx).orderBy(rx)))

    rows = staged(docs.sparkSession, planned(docs, plan, id_col, text_col, source_col), "planned")
    own = docs.withColumn(f"{_IN}rx", F.xxhash64(text_col))
    if rows.groupBy("doc_id", "rx").count().where("count > 1").isEmpty():
        # no equal rows: texts need not be brought together to be numbered
        rows, own = rows.withColumn(f"{_IN}nth", F.lit(1)), own.withColumn(f"{_IN}nth", F.lit(1))
    else:
        rows, own = nth(rows, "doc_id", "rx"), nth(own, id_col, f"{_IN}rx")
    uses = _positions(rows).select(*(F.col(c).alias(f"{_IN}use_{c}") for c in ("doc_id", "rx", f"{_IN}nth", "words", "size", "position")))
    use = lambda name: F.col(f"{_IN}use_{name}")
    joined = own.join(uses, F.col(id_col).eqNullSafe(use("doc_id")) & (F.col(f"{_IN}rx") == use("rx")) & (F.col(f"{_IN}nth") == use(f"{_IN}nth")))
    head = F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.lit(1), F.greatest(use("words"), F.lit(1)).cast("int"))
    text = F.when(use("words") < use("size"), F.array_join(head, " ")).otherwise(F.col(text_col))
    return joined.withColumn(text_col, text).repartitionByRange(use("position")).sortWithinPartitions(use("position")).select(*docs.columns)
