"""From raw documents to token ids, in stages that are written and read again one after the other.

Each stage takes (spark, docs, sf_dir), calls one operator of `roadtally.llm`
on all that the stage before kept, and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadtally.llm.common import staged
from roadtally.llm.decontaminate import contamination
from roadtally.llm.language_id import keep_known, train
from roadtally.llm.mixing import mix
from roadtally.llm.near_dedup import near_duplicates
from roadtally.llm.token_output import token_output
from roadtally.operators.windows import dense_row_number

#: Score below which a document's language counts as not found.
LEAST_SCORE = 0.4

#: No SQL: a network decides the first stage and a tokenizer makes the last.
ORACLE_SQL = None


#: A row's own name within a stage: its id and the digest of its text, so that rows without id are judged apart.
_ROW = "__row"


def _named(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_ROW, F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("rx")))


def _without(named: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows that `rejected` does not name (its column doc_id)."""
    gone = rejected.select(F.col("doc_id").alias("gone")).distinct()
    return named.join(gone, named[_ROW] == gone["gone"], "left_anti").drop(_ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is found with less than LEAST_SCORE, go."""
    return keep_known(docs, train(docs), LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays. Rows without id stay.

    Rows of one id with different texts are documents of their own, in the
    order of their texts' digests; of equal rows (id and text) one stays. Where
    neither occurs, which a count of ids and digests tells, ids name the rows.
    """
    text = F.xxhash64("text")
    names = staged(spark, docs.where("doc_id is not null").groupBy("doc_id", text.alias("rx")).agg(F.count(F.lit(1)).alias("n")), "row-names")
    if names.where("n > 1").isEmpty() and names.groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone"))
        return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
    numbers = dense_row_number(names.select(F.col("doc_id").alias("__id"), F.col("rx").alias("__rx")), ["__id", "__rx"], _ROW)
    same = (docs["doc_id"] == numbers["__id"]) & (text == numbers["__rx"])
    rows = staged(spark, docs.join(numbers, same, "left").drop("__id", "__rx"), "named-rows")
    gone = near_duplicates(rows, id_col=_ROW).where("not kept").select(F.col("doc_id").alias("gone"))
    left = rows.join(gone, rows[_ROW] == gone["gone"], "left_anti")
    equal = Window.partitionBy(_ROW).orderBy(F.xxhash64(*docs.columns))
    one = left.where(F.col(_ROW).isNotNull()).withColumn("__nth", F.row_number().over(equal)).where("__nth = 1")
    return one.select(*docs.columns).unionByName(left.where(F.col(_ROW).isNull()).select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    rows = _named(docs)
    found = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=_ROW)
    return _without(rows, found.where("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; in training order, which the next stage does not keep."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in doc_id order, not in training order, and what they hold of each document: doc_id, start, n_tokens, ids_crc32."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return token_output(docs, file.read()).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mixed), ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each one's result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
