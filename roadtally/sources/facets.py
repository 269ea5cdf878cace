"""Facet lists (filter options): document, key-value table, loading with fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.functions.text import clean_label
from roadtally.sources.readers import path_exists

FACETS = ("boroughs", "years", "vehicle_types", "factors")
# Summary column behind each facet.
SUMMARY_COLUMNS = {"boroughs": "borough", "years": "year", "vehicle_types": "vehicle_type", "factors": "factor"}


def facet_document(facets: DataFrame, columns_count: int | None = None) -> DataFrame:
    """(facet, value) rows -> one row with a sorted array per facet, for small tables.

    A list of a whole facet is one cell; a facet of very many values is better
    kept as the (facet, value) table, which `write_facets` writes as well.
    """
    arrays = []
    for name in FACETS:
        mine = F.collect_list(F.when(F.col("facet") == name, F.col("value")))
        values = F.array_sort(F.transform(mine, lambda v: v.cast("int")) if name == "years" else mine)
        arrays.append(values.alias(name))
    doc = facets.agg(*arrays)
    return doc.withColumn("columns_count", F.lit(columns_count)) if columns_count is not None else doc


def key_value(doc: DataFrame) -> DataFrame:
    """Document row -> (key, value as JSON text) rows."""
    pairs = []
    for c in doc.columns:
        listed = dict(doc.dtypes)[c].startswith("array")
        text = F.to_json(c) if listed else F.col(c).cast("string")
        pairs.append(F.struct(F.lit(c).alias("key"), text.alias("value")))
    return doc.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def write_facets(facets: DataFrame, folder: str, columns_count: int | None = None, mode: str = "overwrite") -> None:
    """Write the document as JSON, the key-value table and the (facet, value) table as Parquet."""
    facets.write.mode(mode).parquet(f"{folder}/facet_values")
    doc = facet_document(facets.sparkSession.read.schema(facets.schema).parquet(f"{folder}/facet_values"), columns_count=columns_count)
    doc.write.mode(mode).json(f"{folder}/metadata_json")
    key_value(doc).write.mode(mode).parquet(f"{folder}/metadata_parquet")


def from_summary(summary: DataFrame) -> DataFrame:
    """(facet, value) rows of the non-null values of a summary table."""
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value"))
            for f, c in SUMMARY_COLUMNS.items()
        ]
    )
    return summary.select(F.explode(cells).alias("p")).select("p.*").where("value is not null").distinct()


def clean_facets(facets: DataFrame) -> DataFrame:
    """Cleaned vehicle and factor labels; labels that become equal are one."""
    text = F.when(F.col("facet").isin("vehicle_types", "factors"), clean_label("value")).otherwise(F.col("value"))
    return facets.select("facet", text.alias("value")).where("trim(value) <> ''").distinct()


def load_facets(spark: SparkSession, folder: str, summary: DataFrame | None = None) -> DataFrame:
    """(facet, value) rows from the JSON document, else the key-value table, else a summary."""
    as_json, as_table = f"{folder}/metadata_json", f"{folder}/metadata_parquet"
    if path_exists(spark, as_json):
        schema = "boroughs array<string>, years array<string>, vehicle_types array<string>, factors array<string>"
        doc = spark.read.schema(schema).json(as_json)
        parts = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("v")) for f in FACETS])
        rows = doc.select(F.explode(parts).alias("p")).select("p.facet", F.explode("p.v").alias("value"))
    elif path_exists(spark, as_table):
        table = spark.read.parquet(as_table).where(F.col("key").isin(*FACETS))
        rows = table.select(F.col("key").alias("facet"), F.explode(F.from_json("value", "array<string>")).alias("value"))
    elif summary is not None:
        rows = from_summary(summary)
    else:
        rows = spark.createDataFrame([], "facet string, value string")
    return clean_facets(rows)
