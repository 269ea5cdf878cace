"""Correlation, exact quantiles, imputation, profiles and hotspots."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.operators.columns import quoted
from roadtally.operators.joins import lookup_join
from roadtally.session import written

BUCKETS = 1024


def _pair_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both values; null when one is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation_matrix(df: DataFrame, cols: list[str], fill: float | None = None) -> DataFrame:
    """(col_x, col_y, corr) for all pairs, by one aggregate; `fill` replaces nulls."""
    value = {c: F.col(quoted(c)).cast("double") for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[_pair_corr(value[a], value[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    at = {frozenset(p): f"r{i}" for i, p in enumerate(pairs)}
    cells = [
        F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(at[frozenset((a, b))]).alias("corr"))
        for a in cols
        for b in cols
    ]
    out = row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return out.withColumn("corr", F.coalesce("corr", F.lit(fill))) if fill is not None else out


# Accuracy of the sketch that brackets the ranks: a value's rank is off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


@dataclass
class _Rank:
    """The k-th smallest (from 0) of a column's finite values, known to lie in lo..hi; k counts from the least of lo..hi if `inside`."""

    column: int
    k: int
    lo: float
    hi: float
    inside: bool = False


def _narrow(values: DataFrame, ranks: list[_Rank], buckets: int) -> None:
    """One pass: cut the ranges into buckets and keep for each rank the bucket that holds it.

    Buckets are counted per task before the shuffle; the result has at most
    ranges x (buckets + 1) rows. Bucket -1 counts the values below a range.
    """
    ranges = sorted({(r.column, r.lo, r.hi) for r in ranks})
    wanted = F.array().cast("array<struct<id:int,lo:double,hi:double>>")
    for column in sorted({c for c, _, _ in ranges}):
        mine = [
            F.struct(F.lit(i).alias("id"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
            for i, (c, lo, hi) in enumerate(ranges)
            if c == column
        ]
        wanted = F.when(F.col("c") == column, F.array(*mine)).otherwise(wanted)
    hits = values.select("v", F.explode(F.filter(wanted, lambda t: F.col("v") <= t.hi)).alias("t"))
    # Halves first: the span of two finite numbers may be infinite.
    share = F.try_divide(F.col("v") / 2 - F.col("t.lo") / 2, F.col("t.hi") / 2 - F.col("t.lo") / 2)
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1))
    at = F.when(F.col("v") < F.col("t.lo"), -1).otherwise(inside)
    rows = (
        hits.groupBy(F.col("t.id").alias("id"), at.alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    histograms: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: r["b"]):
        histograms.setdefault(row["id"], []).append(row)
    place = {r: i for i, r in enumerate(ranges)}
    for rank in ranks:
        before = (rank.lo, rank.hi)
        for row in histograms[place[rank.column, rank.lo, rank.hi]]:
            if row["b"] == -1 and rank.inside:
                continue
            if rank.k < row["n"]:
                rank.lo, rank.hi = row["lo"], row["hi"]
                break
            rank.k -= row["n"]
        rank.inside = True
        if (rank.lo, rank.hi) == before and rank.lo < rank.hi:
            raise ArithmeticError(f"no progress between {rank.lo} and {rank.hi}")


def quantiles(df: DataFrame, cols: list[str], qs: list[float], buckets: int = BUCKETS) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns, with linear interpolation between neighbours.

    A sketch of all columns brackets every rank to about 1 / ACCURACY of the
    rows on either side; one more pass counts what lies below and cuts the
    brackets into buckets, which leaves few values each. A further pass is
    needed only where a bucket still holds different values. A pass reads the
    columns once, shuffles counts only and sends a bounded number of rows to
    the driver. Nulls and NaN are left out; the infinities are the first and
    the last ranks.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(quoted(c)).try_cast("double").alias("v")) for i, c in enumerate(cols)])
    every = df.select(F.explode(cells).alias("p")).select("p.*").where("v is not null and not isnan(v)")
    size = F.abs(F.col("v"))
    values = every.where(size < float("inf"))
    finite = F.when(size < float("inf"), F.col("v"))
    points = sorted({min(1.0, max(0.0, q + d)) for q in qs for d in (-2 / ACCURACY, 2 / ACCURACY)})
    by_column = every.groupBy("c").agg(
        F.count(finite).alias("n"), F.count(F.when(F.col("v") == float("-inf"), 1)).alias("low"), F.count(F.when(F.col("v") == float("inf"), 1)).alias("high"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi"), F.percentile_approx(finite, points, ACCURACY).alias("near"),
    )
    spans = {r["c"]: r for r in by_column.collect()}
    places = {c: [(s["low"] + s["n"] + s["high"] - 1) * q for q in qs] for c, s in spans.items()}
    ranks: dict[tuple[int, int], _Rank] = {}
    for c, at in places.items():
        s = spans[c]
        for k in {f(x) for x in at for f in (math.floor, math.ceil)}:
            own = k - s["low"]
            if own < 0 or own >= s["n"]:
                end = float("-inf") if own < 0 else float("inf")
                ranks[c, k] = _Rank(c, own, end, end)
                continue
            # the sketch's values below and above the rank, with the allowance for its error
            part = own / max(1, s["n"] - 1)
            below = [v for p, v in zip(points, s["near"]) if p <= part - 1 / ACCURACY]
            above = [v for p, v in zip(points, s["near"]) if p >= part + 1 / ACCURACY]
            ranks[c, k] = _Rank(c, own, max(below, default=s["lo"]), min(above, default=s["hi"]))
    while open_ranks := [r for r in ranks.values() if r.lo < r.hi]:
        _narrow(values, open_ranks, buckets)
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        if i not in spans:
            out[c] = [None for _ in qs]
            continue
        ends = [(ranks[i, math.floor(x)].lo, ranks[i, math.ceil(x)].lo, x - math.floor(x)) for x in places[i]]
        out[c] = [low if low == high or not part else low + (high - low) * part for low, high, part in ends]
    return out


def exact_quantiles(df: DataFrame, c: str, qs: list[float], buckets: int = BUCKETS) -> list[float | None]:
    return quantiles(df, [c], qs, buckets)[c]


def iqr_bounds(df: DataFrame, c: str, k: float = 1.5) -> tuple[float | None, float | None]:
    q1, q3 = exact_quantiles(df, c, [0.25, 0.75])
    if q1 is None:
        return None, None
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def iqr_outliers(df: DataFrame, c: str, k: float = 1.5) -> DataFrame:
    """Rows below Q1 - k IQR or above Q3 + k IQR."""
    lo, hi = iqr_bounds(df, c, k)
    value = F.col(quoted(c)).try_cast("double")
    return df.where((value < F.lit(lo)) | (value > F.lit(hi)))


def box_stats(df: DataFrame, c: str, k: float = 1.5) -> DataFrame:
    """One row: count, min, quartiles, max and the whisker ends inside the fences."""
    q1, median, q3 = exact_quantiles(df, c, [0.25, 0.5, 0.75])
    value = F.col(quoted(c)).try_cast("double")
    lo = F.lit(None if q1 is None else q1 - k * (q3 - q1)).cast("double")
    hi = F.lit(None if q1 is None else q3 + k * (q3 - q1)).cast("double")
    return df.agg(
        F.count(value).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.min(F.when(value >= lo, value)).alias("lower_whisker"),
        F.max(F.when(value <= hi, value)).alias("upper_whisker"),
    ).withColumns({"q1": F.lit(q1).cast("double"), "median": F.lit(median).cast("double"), "q3": F.lit(q3).cast("double")})


def histogram(df: DataFrame, c: str, nbins: int = 30) -> DataFrame:
    """Equal-width bins from the least to the largest finite value; the largest belongs to the last bin. Empty bins are left out.

    Infinite values have bins of their own, -1 and `nbins`. The values are
    read twice, for the ends and for the counts; counts alone are shuffled.
    """
    value = F.col(quoted(c)).try_cast("double")
    values = df.select(value.alias("v")).where("v is not null and not isnan(v)")
    finite = F.when(F.abs(F.col("v")) < float("inf"), F.col("v"))
    ends = values.agg(F.struct(F.min(finite).alias("lo"), F.max(finite).alias("hi"))).scalar()
    spans = values.withColumn("_ends", ends).withColumns({"_lo": F.col("_ends.lo"), "_w": (F.col("_ends.hi") - F.col("_ends.lo")) / F.lit(float(nbins))})
    inside = F.least(F.coalesce(F.floor(F.try_divide(finite - F.col("_lo"), F.col("_w"))), F.lit(0)), F.lit(nbins - 1))
    at = F.when(F.col("v") == float("-inf"), -1).when(F.col("v") == float("inf"), nbins).otherwise(inside)
    out = spans.groupBy(at.cast("int").alias("bin"), "_lo", "_w").agg(F.count(F.lit(1)).alias("cnt"))
    start = F.col("_lo") + F.col("bin") * F.col("_w")
    first, last = F.col("bin") < 0, F.col("bin") >= nbins
    return out.select(
        "bin", F.when(first, F.lit(float("-inf"))).otherwise(start).alias("bin_start"),
        F.when(last, F.lit(float("inf"))).otherwise(start + F.col("_w")).alias("bin_end"), "cnt",
    ).orderBy("bin")


def impute_mean(df: DataFrame, c: str, lo: float, hi: float) -> DataFrame:
    """Values that are null or not inside (lo, hi) become the mean of those that are."""
    value = F.col(quoted(c)).try_cast("double")
    valid = F.when((value > lo) & (value < hi), value)
    mean = df.agg(F.avg(valid)).scalar()
    return df.withColumn(c, F.coalesce(valid, mean))


def mode_by_group(df: DataFrame, group: str, target: str) -> DataFrame:
    """Most frequent non-null value per non-null group, the smallest one on a tie."""
    counts = df.where(F.col(quoted(group)).isNotNull()).groupBy(quoted(group), quoted(target)).agg(F.count(F.lit(1)).alias("_n"))
    ranked = F.when(F.col(quoted(target)).isNotNull(), F.struct(-F.col("_n"), F.col(quoted(target))))
    return counts.groupBy(quoted(group)).agg(F.min_by(quoted(target), ranked).alias("mode"))


def fill_mode_by_group(df: DataFrame, group: str, target: str, invalid: tuple[str, ...], fallback: str = "Unknown") -> DataFrame:
    """Null or invalid targets take the group's mode; without a group they take the fallback.

    The mode counts placeholders like any other value. A group that is known
    but has no value at all stays null.
    """
    modes = mode_by_group(df, group, target).withColumn("_known", F.lit(True))
    joined = lookup_join(df, modes, group)
    bad = F.col(quoted(target)).isNull() | F.col(quoted(target)).isin(*invalid)
    filled = F.when(F.col("_known"), F.col("mode")).otherwise(F.lit(fallback))
    return joined.withColumn(target, F.when(bad, filled).otherwise(F.col(quoted(target)))).select(*[quoted(c) for c in df.columns])


def null_profile(df: DataFrame, cols: list[str] | None = None, k: int | None = None) -> DataFrame:
    """(column, nulls, null_rate), most nulls first."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column"), (F.col("n") - F.col(f"c{i}")).alias("nulls")) for i, c in enumerate(cols)]
    out = row.select("n", F.explode(F.array(*cells)).alias("c")).select(
        "c.column", "c.nulls", F.try_divide(F.col("c.nulls").cast("double"), F.col("n").cast("double")).alias("null_rate")
    )
    out = out.orderBy(F.desc("nulls"), "column")
    return out.limit(k) if k else out


def distinct_profile(df: DataFrame, cols: list[str], limit: int = 50) -> DataFrame:
    """(column, distinct_values, values): the sorted values where there are at most `limit`, else null."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in cols])
    pairs = written(df.select(F.explode(cells).alias("p")).select("p.*").where("value is not null").distinct(), "values")
    sizes = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    # One row per column name, so both sides of this join are as small as the schema.
    few = pairs.join(F.broadcast(sizes.where(F.col("distinct_values") <= limit)), "column", "left_semi")
    lists = few.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values"))
    return sizes.join(lists, "column", "left").orderBy("column")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max) with exact quartiles."""
    value = {c: F.col(quoted(c)).try_cast("double") for c in cols}
    row = df.agg(
        *[
            F.struct(
                F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(f"s{i}")
            for i, v in enumerate(value.values())
        ]
    )
    quartiles = quantiles(df, cols, [0.25, 0.5, 0.75])
    parts = []
    for i, c in enumerate(cols):
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        s = F.col(f"s{i}")
        parts.append(
            F.struct(
                F.lit(c).alias("column"), s["count"].alias("count"), s["mean"].alias("mean"), s["std"].alias("std"),
                s["min"].alias("min"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), s["max"].alias("max"),
            )
        )
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def hotspots(df: DataFrame, k: int = 10, seed: int = 42, lat: str = "latitude", lon: str = "longitude", min_rows: int = 10) -> DataFrame:
    """K-means clusters of the coordinates: (lat, lon, points, cluster, cluster_size).

    Rows at the same place are merged and weighted by their number, which
    leaves the objective unchanged and shrinks the data the iterations read.
    The merged points are a table in the shared folder.
    With `min_rows` rows or fewer there are no clusters.
    """
    points = (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.col(lat).cast("double").alias(lat), F.col(lon).cast("double").alias(lon))
        .agg(F.count(F.lit(1)).cast("double").alias("points"))
    )
    points = written(points, "points")
    vectors = VectorAssembler(inputCols=[lat, lon], outputCol="_xy").transform(points)
    size = vectors.agg(F.sum("points").alias("n"), F.count(F.lit(1)).alias("d")).first()
    if (size["n"] or 0) <= min_rows:
        return points.where("false").select(lat, lon, F.col("points").cast("bigint"), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("cluster_size"))
    model = KMeans(k=min(k, size["d"]), seed=seed, featuresCol="_xy", predictionCol="cluster", weightCol="points").fit(vectors)
    placed = model.transform(vectors).drop("_xy")
    # At most k rows.
    sizes = placed.groupBy("cluster").agg(F.sum("points").cast("bigint").alias("cluster_size"))
    out = placed.join(F.broadcast(sizes), "cluster")
    return out.select(lat, lon, F.col("points").cast("bigint").alias("points"), "cluster", "cluster_size")
