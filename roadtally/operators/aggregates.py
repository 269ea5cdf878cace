"""Group-bys over one or more dimensions, label lists, pivots and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.functions.numbers import rate
from roadtally.functions.temporal import trunc_to
from roadtally.functions.text import or_unknown, parse_list, split_clean, strip
from roadtally.operators.columns import quoted
from roadtally.operators.joins import keep_top
from roadtally.session import written


def _dims(dims: str | list[str]) -> list[str]:
    return [dims] if isinstance(dims, str) else list(dims)


def count_by(
    df: DataFrame,
    dims: str | list[str],
    k: int | None = None,
    count_col: str | None = None,
    keep_null: bool = True,
    name: str = "cnt",
) -> DataFrame:
    """Rows (or non-null `count_col` values) per combination of dimensions, most first.

    `k` keeps the k largest; ties go by the dimensions' values.
    """
    names = _dims(dims)
    if not keep_null:
        df = df.dropna(how="any", subset=names)
    n = F.count(quoted(count_col)) if count_col else F.count(F.lit(1))
    out = df.groupBy(*[quoted(d) for d in names]).agg(n.alias(name)).orderBy(F.desc(name), *[quoted(d) for d in names])
    return out.limit(k) if k else out


def sum_by(df: DataFrame, dims: str | list[str], measures: list[str], keep_null: bool = True) -> DataFrame:
    names = _dims(dims)
    if not keep_null:
        df = df.dropna(how="any", subset=names)
    sums = [F.sum(F.coalesce(F.col(quoted(m)), F.lit(0))).alias(m) for m in measures]
    return df.groupBy(*[quoted(d) for d in names]).agg(*sums).orderBy(*[quoted(d) for d in names])


def mean_by(df: DataFrame, dim: str, measure: str, k: int | None = None, name: str = "mean") -> DataFrame:
    """Mean per group, nulls skipped, largest first. On a summary this is a mean of means."""
    out = (
        df.where(F.col(quoted(dim)).isNotNull())
        .groupBy(quoted(dim))
        .agg(F.avg(quoted(measure)).alias(name))
        .orderBy(F.desc(name), quoted(dim))
    )
    return out.limit(k) if k else out


def share_by(df: DataFrame, dim: str, weight: str | None = None) -> DataFrame:
    """Count (or summed weight) per value and its share of the total."""
    n = F.sum(quoted(weight)) if weight else F.count(F.lit(1))
    groups = df.groupBy(quoted(dim)).agg(n.alias("cnt"))
    total = groups.agg(F.sum("cnt")).scalar()
    return groups.withColumn("share", rate("cnt", total)).orderBy(F.desc("cnt"), quoted(dim))


def top_k(df: DataFrame, c: str, k: int) -> DataFrame:
    return count_by(df.where(F.col(quoted(c)).isNotNull()), c, k)


def labels_of(df: DataFrame, c: str, style: str = "list") -> Column:
    """Label array of a list column of df.

    `list` reads text as a list; `known` does and gives 'Unknown' for an empty
    one; `split` only splits at commas; `comma` does too and keeps blank
    labels. A column that is an array already is taken as it is.
    """
    if style not in ("list", "known", "split", "comma"):
        raise ValueError(f"unknown list style {style!r}")
    name = quoted(c)
    if isinstance(df.schema[c].dataType, T.ArrayType):
        values = F.filter(F.transform(name, strip), lambda v: v != "")
        return or_unknown(values) if style == "known" else F.coalesce(values, F.array().cast("array<string>"))
    if style in ("split", "comma"):
        return split_clean(name, drop_blank=style == "split")
    return or_unknown(parse_list(name)) if style == "known" else parse_list(name)


def count_labels(
    df: DataFrame,
    text: str,
    keys: list[str] | None = None,
    style: str = "list",
    name: str = "label",
    where=None,
) -> DataFrame:
    """Occurrences of each label in a list-text column, per `keys`.

    Equal texts are counted before they are parsed, so parsing and exploding
    work on the distinct texts only. Where most texts are distinct, this first
    count is one more shuffle of them.
    """
    keys = keys or []
    texts = df.groupBy(*[quoted(k) for k in keys], quoted(text)).agg(F.count(F.lit(1)).alias("_n"))
    rows = texts.select(*[quoted(k) for k in keys], F.explode(labels_of(df, text, style)).alias(name), "_n")
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*[quoted(k) for k in keys], quoted(name)).agg(F.sum("_n").alias("cnt"))


def top_labels(df: DataFrame, text: str, k: int, style: str = "list", name: str = "label") -> DataFrame:
    return count_labels(df, text, style=style, name=name).orderBy(F.desc("cnt"), name).limit(k)


def pair_matrix(df: DataFrame, first: str, second: str, style: str = "list", names=("vehicle", "factor")) -> DataFrame:
    """Count of each (label of first, label of second) within a row, over all rows."""
    texts = df.groupBy(quoted(first), quoted(second)).agg(F.count(F.lit(1)).alias("_n"))
    pairs = texts.select(F.explode(labels_of(df, first, style)).alias(names[0]), labels_of(df, second, style).alias("_second"), "_n")
    pairs = pairs.select(names[0], F.explode("_second").alias(names[1]), "_n")
    return pairs.groupBy(*names).agg(F.sum("_n").alias("cnt")).orderBy(F.desc("cnt"), *names)


def pivot_top(df: DataFrame, index: str, c: str, value: str | None, k: int) -> DataFrame:
    """Wide table index x the k largest values of `c`, summed, 0 where nothing is.

    The k column names are read first, so that the pivot knows its columns;
    the summed cells are a table of their own for that.
    """
    weight = F.col(quoted(value)) if value else F.lit(1)
    cells = written(df.where(F.col(quoted(c)).isNotNull()).groupBy(quoted(index), quoted(c)).agg(F.sum(weight).alias("_v")), "cells")
    ranked = cells.groupBy(quoted(c)).agg(F.sum("_v").alias("_v")).orderBy(F.desc("_v"), quoted(c)).limit(k)
    names = [r[0] for r in ranked.collect()]
    wide = cells.groupBy(quoted(index)).pivot(c, names).agg(F.sum("_v")) if names else cells.select(quoted(index)).distinct()
    return wide.na.fill(0, names).orderBy(quoted(index))


def unpivot(df: DataFrame, ids: list[str], values: list[str] | None = None, name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values or [c for c in df.columns if c not in ids], name, value)


def top_cross(df: DataFrame, a: str, b: str, k: int) -> DataFrame:
    """Counts over (a, b) for the k most frequent values of `a`."""
    return count_by(keep_top(df, a, k), [a, b], keep_null=False)


def value_counts(df: DataFrame, cols: list[str], k: int | None = None) -> DataFrame:
    """Counts over several columns stacked into one, nulls skipped.

    Each combination of the columns is counted once before it is stacked.
    """
    combos = df.groupBy(*[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    stacked = combos.select(F.explode(F.array(*[F.col(quoted(c)).cast("string") for c in cols])).alias("value"), "_n")
    out = stacked.where("value is not null").groupBy("value").agg(F.sum("_n").alias("cnt")).orderBy(F.desc("cnt"), "value")
    return out.limit(k) if k else out


def facet_values(df: DataFrame, c: str) -> DataFrame:
    """Distinct trimmed, non-blank values of a column."""
    values = df.select(strip(F.col(quoted(c)).cast("string")).alias("value")).where("value <> ''")
    return values.distinct().orderBy("value")


def kpis(df: DataFrame, crashes: str | None = None) -> DataFrame:
    """Rows, injured, killed, injured per row (0 for no rows); `crashes` adds a distinct count."""
    out = [
        F.count(F.lit(1)).alias("crashes"),
        F.coalesce(F.sum("total_injured"), F.lit(0)).alias("injured"),
        F.coalesce(F.sum("total_killed"), F.lit(0)).alias("killed"),
    ]
    if crashes:
        out.append(F.count_distinct(quoted(crashes)).alias("distinct_crashes"))
    return df.agg(*out).withColumn("injured_per_crash", F.coalesce(rate("injured", "crashes"), F.lit(0.0)))


def time_series(df: DataFrame, ts: str, unit: str = "Month", label: str = "start") -> DataFrame:
    """Rows per period, with 0 for periods in between that have none.

    `label='end'` names a month or year by its last day.
    """
    counts = df.select(trunc_to(quoted(ts), unit).alias("period")).where("period is not null").groupBy("period").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    steps = {"year": "INTERVAL '1' YEAR", "month": "INTERVAL '1' MONTH", "day": "INTERVAL '1' DAY"}
    step = F.expr(steps[unit.lower()])
    periods = counts.agg(F.min("period").alias("a"), F.max("period").alias("b")).where("a is not null").select(
        F.explode(F.sequence("a", "b", step)).alias("period")
    )
    out = periods.join(counts, "period", "left").select("period", F.coalesce("cnt", F.lit(0)).alias("cnt"))
    if label == "end":
        ends = {"year": F.add_months("period", 12) - 1, "month": F.last_day("period"), "day": F.col("period")}
        out = out.withColumn("period", ends[unit.lower()])
    return out.orderBy("period")
