"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.functions.temporal import try_ts
from roadtally.operators.columns import quoted
from roadtally.session import written

# No task should get more than this share of the rows. A key above it is hot;
# by pigeonhole at most 1 / SHARE keys are.
SHARE = 1 / 4096
# Share of the rows that is looked at to nominate hot keys, and the least hits for it.
HOT_SAMPLE = 0.01
HOT_MIN_HITS = 1000
# Largest lookup that is sent to every executor, in rows and in bytes.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20


def hot_keys(
    df: DataFrame,
    key: str,
    share: float = SHARE,
    sample: float = HOT_SAMPLE,
    min_hits: int = HOT_MIN_HITS,
) -> dict:
    """Values of `key` (null included) with more than `share` of the rows -> their share.

    There are at most 1 / share of them. They only steer how rows are spread,
    never which rows a result holds, so a sample is enough to nominate keys.
    """
    picked = df.select(F.col(quoted(key)).alias("k"))
    if sample < 1.0:
        picked = picked.sample(fraction=sample, seed=7)
    counts = picked.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(counts.agg(F.sum("n").alias("total")).scalar(), F.lit(0))
    hot = counts.where(F.col("n") > F.greatest(total * F.lit(share), F.lit(float(min_hits))))
    return {r["k"]: r["part"] for r in hot.select("k", F.try_divide(F.col("n").cast("double"), total).alias("part")).collect()}


def hot_table(df: DataFrame, key: str, values: dict, name: str) -> DataFrame:
    """(key, value) rows of a small dictionary, with the key's type in df; null is left out."""
    rows = [(k, v) for k, v in values.items() if k is not None]
    kind = "int" if not rows or isinstance(rows[0][1], int) else "array<double>"
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(name, T._parse_datatype_string(kind))])
    return df.sparkSession.createDataFrame(rows, schema)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: dict | None = None,
    share: float = SHARE,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Equi-join on one key whose hot values are spread over many tasks.

    A hot key gets as many places as its share asks for. A left row goes to one
    of them, chosen by a hash of `spread_by` (default: all its columns); right
    rows with the key are copied to all of them. Other rows are not copied, and
    left rows without a key, which match nothing, are spread as well. Without
    hot keys this is a plain join. AQE splits what still turns out large.
    """
    if hot is None:
        hot = hot_keys(left, key)
    if not hot:
        return left.join(right, key, how)
    places = {k: max(2, math.ceil(part / share)) for k, part in hot.items()}
    # At most 1 / share rows.
    table = F.broadcast(hot_table(left, key, places, "_places"))
    no_key = F.when(F.col(quoted(key)).isNull(), F.lit(places.get(None, 1)))
    number = F.coalesce(F.col("_places"), no_key, F.lit(1))
    spread = F.xxhash64(*[F.col(quoted(c)) for c in (spread_by or left.columns)])
    salted_left = left.join(table, key, "left").withColumn("_salt", F.pmod(spread, number).cast("int")).drop("_places")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_places"), F.lit(1)) - 1))
    salted_right = right.join(table, key, "left").withColumn("_salt", copies).drop("_places")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join to a lookup with one row per key.

    The lookup is computed once. Up to `max_rows` rows and MAX_BROADCAST_BYTES
    it is broadcast as a local table; a larger one is joined by `spread_join`.
    """
    rows = lookup.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > MAX_BROADCAST_BYTES:
        return spread_join(df, lookup, key, how)
    small = df.sparkSession.createDataFrame(rows, lookup.schema)
    return df.join(F.broadcast(small), key, how)


def first_per_key(df: DataFrame, key: str, values: list[str], order: str) -> DataFrame:
    """First non-null value of each column per key, in the given order."""
    firsts = [
        F.min_by(quoted(v), F.when(F.col(quoted(v)).isNotNull(), F.col(quoted(order)))).alias(v) for v in values
    ]
    return df.where(F.col(quoted(key)).isNotNull()).groupBy(quoted(key)).agg(*firsts)


def integrate(
    persons: DataFrame,
    crashes: DataFrame,
    key: str = "collision_id",
    ts: str = "crash_datetime",
    row_key: str | None = "unique_id",
    hot: dict | None = None,
) -> DataFrame:
    """Persons LEFT JOIN crashes, one row per person.

    Where both sides have the timestamp, the crash's wins and the person's is
    the fallback. Other columns of the same name keep the person's value.
    """
    own = [c for c in persons.columns if c not in (key, ts)]
    right = crashes.select(key, *[quoted(c) for c in crashes.columns if c != key and c not in own])
    both = ts in persons.columns and ts in crashes.columns
    if both:
        right = right.withColumnRenamed(ts, "_crash_ts")
    spread = [row_key] if row_key in persons.columns else None
    joined = spread_join(persons, right, key, "left", hot=hot, spread_by=spread)
    if both:
        joined = joined.withColumn(ts, F.coalesce(try_ts("_crash_ts"), try_ts(ts))).drop("_crash_ts")
    return joined


def fill_from(df: DataFrame, other: DataFrame, on: str, cols: list[str]) -> DataFrame:
    """Own value, else the value of the row with the same key in `other` (one row per key)."""
    theirs = other.select(on, *[F.col(quoted(c)).alias(f"_other_{c}") for c in cols])
    joined = spread_join(df, theirs, on, "left")
    filled = joined.withColumns({c: F.coalesce(F.col(quoted(c)), F.col(f"_other_{c}")) for c in cols})
    return filled.drop(*[f"_other_{c}" for c in cols])


def lookup_fill(
    df: DataFrame,
    lookup: DataFrame,
    keys: list[tuple[str, Column, Column]],
    cols: dict[str, str],
    order: str,
    later_wins: bool = False,
) -> DataFrame:
    """Fill missing columns from a lookup by several keys in turn.

    `keys` holds (name, key of df, key of lookup); `cols` maps a column of df
    to the lookup column it is filled from. Per key the first value in
    `order` counts. Rows that lack nothing take no part in any shuffle. The
    earlier key has priority; with `later_wins` the later one has. The rows
    that lack something are written once with their keys, so that neither the
    look at their hot keys nor the join runs what makes them again.
    """
    lacking = reduce(or_, [F.col(quoted(c)).isNull() for c in cols])
    whole = df.where(~lacking)
    part = written(df.where(lacking).withColumns({f"_key_{i}": own for i, (_, own, _) in enumerate(keys)}), "lacking")
    hot = [hot_keys(part, f"_key_{i}") for i in range(len(keys))]
    found: dict[str, list[Column]] = {c: [] for c in cols}
    temporary = []
    for i, (_, _, lookup_key) in enumerate(keys):
        k = f"_key_{i}"
        keyed = lookup.withColumn(k, lookup_key)
        firsts = first_per_key(keyed, k, list(cols.values()), order)
        firsts = firsts.withColumnsRenamed({v: f"_found_{i}_{v}" for v in cols.values()})
        part = spread_join(part, firsts, k, "left", hot=hot[i])
        temporary += [k, *[f"_found_{i}_{v}" for v in cols.values()]]
        for c, v in cols.items():
            found[c].append(F.col(quoted(f"_found_{i}_{v}")))
    for c in cols:
        candidates = found[c][::-1] if later_wins else found[c]
        part = part.withColumn(c, F.coalesce(F.col(quoted(c)), *candidates))
    return whole.unionByName(part.drop(*temporary).select(*[quoted(c) for c in df.columns]))


def keep_top(df: DataFrame, c: str, k: int) -> DataFrame:
    """Rows whose value is among the k most frequent (ties by value)."""
    top = (
        df.where(F.col(quoted(c)).isNotNull())
        .groupBy(quoted(c))
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), F.col(quoted(c)))
        .limit(k)
        .select(quoted(c))
    )
    return df.join(F.broadcast(top), c, "left_semi")


def unmapped(df: DataFrame, c: str, known: list[str]) -> DataFrame:
    """Distinct non-null values that a mapping does not cover."""
    values = df.where(F.col(quoted(c)).isNotNull()).select(quoted(c)).distinct()
    spark = df.sparkSession
    table = spark.createDataFrame([(v,) for v in sorted(set(known))], f"{quoted(c)} string")
    return values.join(F.broadcast(table), c, "left_anti")


def with_group_size(df: DataFrame, key: str, name: str = "group_size") -> DataFrame:
    """Attach the number of rows with the same key; a null key has none.

    There may be as many keys as rows, so the sizes are joined, not sent around;
    AQE still broadcasts them when they turn out small.
    """
    sizes = df.where(F.col(quoted(key)).isNotNull()).groupBy(quoted(key)).agg(F.count(F.lit(1)).alias(name))
    return spread_join(df, sizes, key)


def min_max_scale(df: DataFrame, c: str, name: str, lo: float = 5, span: float = 30) -> DataFrame:
    """(c - min + 1) / (max - min + 1) * span + lo, with min and max of the whole column."""
    value = F.col(quoted(c))
    least = df.agg(F.min(value)).scalar()
    most = df.agg(F.max(value)).scalar()
    return df.withColumn(name, (value - least + 1) / (most - least + 1) * F.lit(float(span)) + F.lit(float(lo)))
