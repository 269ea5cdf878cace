"""Writing Parquet, partitioned copies, CSV and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from roadtally.functions.temporal import try_ts
from roadtally.operators.columns import has_role, quoted, role_col
from roadtally.sources.readers import NULL, escape_breaks, path_exists


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", codec: str = "snappy") -> None:
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", lossless: bool = False) -> None:
    """CSV with a header; white space at the ends of a value is kept.

    A line break within a value is written inside quotes, which needs a reader
    that takes each file as a whole. `lossless` keeps the files splittable and
    every value apart: backslashes and line breaks are escaped by a backslash
    and null is written as \\N, so that it differs from an empty text;
    `read_csv(..., lossless=True)` undoes both.
    """
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if lossless:
        texts = [c for c, kind in df.dtypes if kind == "string"]
        df = df.withColumns({c: escape_breaks(F.col(quoted(c))) for c in texts})
        keep |= {"nullValue": NULL}
    df.write.mode(mode).options(header=True, escape='"', **keep).csv(path)


def export(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    """CSV export, as one file if the caller asks for it, else one per task."""
    write_csv(df.coalesce(1) if single_file else df, path, mode)


def folder_bytes(df_path: str, spark) -> int:
    """Bytes of all files below a path, as its file system reports them."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(df_path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def with_year(df: DataFrame) -> DataFrame:
    """Add YEAR from the crash time unless it is there."""
    if any(c.lower() == "year" for c in df.columns):
        return df
    year = F.year(try_ts(role_col(df, "crash_datetime"))) if has_role(df, "crash_datetime") else F.lit(None).cast("int")
    return df.withColumn("YEAR", year)


def rewrite_partitioned(
    df: DataFrame,
    out: str,
    partition_cols: list[str] | None = None,
    codec: str = "zstd",
    max_rows: int = 200_000,
    source: str | None = None,
) -> DataFrame:
    """Copy a table into a partitioned layout and report rows and bytes.

    Refuses an existing folder. REBALANCE groups the rows by partition value
    before the write, merges small values and splits a large one by size, so
    that one value with a third of the rows is written by many tasks.
    Dictionary encoding is Parquet's default.
    """
    spark = df.sparkSession
    if path_exists(spark, out):
        raise FileExistsError(out)
    cols = partition_cols if partition_cols is not None else ["YEAR"]
    rows = Observation("rewrite")
    laid_out = with_year(df).observe(rows, F.count(F.lit(1)).alias("rows"))
    if cols:
        laid_out = laid_out.hint("rebalance", *[F.col(quoted(c)) for c in cols])
    writer = laid_out.write.mode("errorifexists").option("compression", codec).option("maxRecordsPerFile", max_rows)
    (writer.partitionBy(*cols) if cols else writer).parquet(out)
    size_in = folder_bytes(source, spark) if source else None
    return spark.createDataFrame(
        [(rows.get["rows"], size_in, folder_bytes(out, spark))], "rows bigint, bytes_in bigint, bytes_out bigint"
    )
