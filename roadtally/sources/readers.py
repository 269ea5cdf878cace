"""Reading CSV, Parquet, batch folders and polygon layers."""

from __future__ import annotations

import csv
import warnings
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.functions.numbers import to_int
from roadtally.operators.columns import quoted
from roadtally.operators.sets import concat

# Names under which a geocode batch column may appear, best first.
GEOCODE_COLUMNS = {
    "latitude_geocode": ("LATITUDE_GEOCODE", "LATITUDE_GEOCODE.1", "LAT", "latitude", "lat", "LATITUDE"),
    "longitude_geocode": ("LONGITUDE_GEOCODE", "LONGITUDE_GEOCODE.1", "LON", "longitude", "lon", "LONGITUDE"),
    "orig_index": ("index", "Unnamed: 0", "_c0", "INDEX"),
    "collision_id": ("COLLISION_ID", "collision_id", "collision id", "collisionid"),
    "full_address": ("FULL ADDRESS", "FULL_ADDRESS", "FULLADDRESS", "address", "ADDRESS"),
}
GEOCODE_TYPES = {
    "latitude_geocode": "double",
    "longitude_geocode": "double",
    "orig_index": "bigint",
    "collision_id": "string",
    "full_address": "string",
}


# How lossless CSV writes a null; texts cannot look like it, as their backslashes are escaped.
NULL = "\\N"


def escape_breaks(text: Column) -> Column:
    """Backslash, line feed and carriage return of a text as backslash and a letter."""
    for char, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape_breaks(text: Column) -> Column:
    """The reverse of `escape_breaks`; the pieces between doubled backslashes are undone apart."""
    pieces = F.split(text, r"\\\\", -1)
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    infer: bool = False,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    lossless: bool = False,
) -> DataFrame:
    """CSV with a header. Columns are text unless a schema is given or types are inferred.

    An empty cell is null. Inference reads the files once more, so give a
    schema for large ones. `multi_line` reads files whose quoted values hold
    line breaks; each file is then one task. `lossless` reads what
    `write_csv(..., lossless=True)` wrote: nulls, empty texts and line breaks
    come back as they were.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    if lossless:
        reader = reader.option("nullValue", NULL).option("emptyValue", "")
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", infer).csv(path)
    if lossless:
        df = df.withColumns({c: unescape_breaks(F.col(quoted(c))) for c, kind in df.dtypes if kind == "string"})
    return df


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    cols: list[str] | None = None,
    skip_corrupt: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet, optionally some columns only and without the files that cannot be read.

    Spark takes the schema from one file; give it where that file may be corrupt.
    """
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*[quoted(c) for c in cols]) if cols else df


def columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a Parquet table, from its schema alone."""
    return spark.read.parquet(path).columns


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on its own file system (local, HDFS, object store)?"""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def first_source(spark: SparkSession, paths: list[str], infer: bool = False) -> DataFrame | None:
    """The first of several CSV or Parquet paths (files or folders) that exists, else None.

    A folder is CSV if a file in it has that ending.
    """
    for path in paths:
        if path_exists(spark, path):
            is_csv = any(name.lower().endswith((".csv", ".csv.gz")) for name in [path, *list_files(spark, path, ("",))])
            return read_csv(spark, path, infer=infer) if is_csv else read_parquet(spark, path)
    return None


def list_files(spark: SparkSession, folder: str, prefixes: tuple[str, ...]) -> list[str]:
    """Files of a folder whose names start with one of the prefixes, sorted."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(target)]
    return sorted(str(p) for p in names if p.getName().startswith(prefixes))


def standard_geocodes(df: DataFrame, *extra: str) -> DataFrame:
    """Geocode batch under its standard column names and types, with `extra` columns as they are."""
    by_name = {c.strip(): c for c in df.columns}
    out = []
    for name, candidates in GEOCODE_COLUMNS.items():
        hit = next((by_name[c] for c in candidates if c in by_name), None)
        if hit is not None:
            value, kind = F.col(quoted(hit)), GEOCODE_TYPES[name]
            out.append((to_int(value) if kind == "bigint" else value.try_cast(kind)).alias(name))
    return df.select(*out, *[quoted(e) for e in extra])


def _headers(spark: SparkSession, paths: list[str]) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Files by header, and files without one, from the first line of every file, found in one pass over them.

    Unnamed and repeated columns are named by their position, as Spark does.
    """
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), line.alias("at"), "value")
    # One line per file.
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("value")).collect()
    kinds: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(first):
        names = next(csv.reader([row["value"]]), [])
        if any(names):
            unique = [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]
            kinds.setdefault(tuple(unique), []).append(row["path"])
    named = {unquote(urlparse(p).path) for files in kinds.values() for p in files}
    return kinds, [p for p in paths if unquote(urlparse(p).path) not in named]


def read_batches(spark: SparkSession, folder: str, prefixes: tuple[str, ...] = ("geocoded_batch_", "batch_")) -> DataFrame:
    """All geocode batches of a folder as one table, with the file name as `batch`.

    Files with the same header are read together, so the plan has one branch
    per kind of header and not one per file. Files without a header row cannot
    be read and are named in a warning.
    """
    paths = list_files(spark, folder, prefixes)
    kinds, left_out = _headers(spark, paths) if paths else ({}, [])
    if not kinds:
        raise FileNotFoundError(f"no readable batch file in {folder}")
    if left_out:
        warnings.warn(f"batch files without a header: {', '.join(left_out)}", stacklevel=2)
    frames = []
    for header, files in kinds.items():
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        raw = read_csv(spark, files, schema=schema).withColumn("batch", F.input_file_name())
        frames.append(standard_geocodes(raw, "batch"))
    return concat(frames)


POINT = T.ArrayType(T.DoubleType())
RING = T.ArrayType(POINT)


def read_polygons(spark: SparkSession, path: str, name: str) -> DataFrame:
    """GeoJSON features -> (place, name, ring), one row per ring.

    `name` is the feature property to use. `place` is the feature's position
    in its file. Polygon and MultiPolygon nest differently, so the coordinates
    are read as text and parsed by the geometry's type.
    """
    schema = (
        f"features array<struct<properties:map<string,string>,"
        f"geometry:struct<type:string,coordinates:string>>>"
    )
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    features = doc.select(F.posexplode("features").alias("place", "f")).select(
        "place", F.col("f.properties").getItem(name).alias("name"), "f.geometry.type", "f.geometry.coordinates"
    )
    one = F.array(F.from_json("coordinates", T.ArrayType(RING)))
    many = F.from_json("coordinates", T.ArrayType(T.ArrayType(RING)))
    parts = features.select("place", "name", F.explode(F.when(F.col("type") == "MultiPolygon", many).otherwise(one)).alias("rings"))
    rings = parts.select("place", "name", F.explode("rings").alias("r"))
    ring = F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rings.select("place", "name", ring.alias("ring"))
