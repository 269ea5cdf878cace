"""Predicates and row filters. An empty selection never filters."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadtally.functions.factors import is_unspecified
from roadtally.functions.numbers import to_int
from roadtally.functions.temporal import try_ts
from roadtally.functions.text import col_of, is_injured
from roadtally.operators.columns import quoted, resolve


def in_set(c: Column | str, values: Iterable | None) -> Column:
    values = list(values or [])
    return col_of(c).isin(*values) if values else F.lit(True)


def in_set_ci(c: Column | str, values: Iterable[str] | None) -> Column:
    """Membership ignoring case; null counts as ''."""
    return in_set(F.lower(F.coalesce(col_of(c), F.lit(""))), [str(v).lower() for v in values or []])


def in_text(c: Column | str, values: Iterable | None) -> Column:
    """Membership of the value as text; null counts as ''."""
    return in_set(F.coalesce(col_of(c).cast("string"), F.lit("")), [str(v) for v in values or []])


def years_in(c: Column | str, years: Iterable[int] | None) -> Column:
    return in_set(c, [int(y) for y in years or []])


def at_least(c: Column | str, n) -> Column:
    return col_of(c) >= n if n else F.lit(True)


def year_between(df: DataFrame, ts: str, first: int, last: int) -> Column:
    """Years first..last, as a half-open range on the column itself.

    The bound has the column's own type, so the comparison reaches the Parquet
    reader; a condition on `year(ts)` would not.
    """
    kind = df.schema[ts].dataType
    name = quoted(ts)
    if isinstance(kind, T.DateType):
        value, cast = F.col(name), "date"
    elif isinstance(kind, T.TimestampType):
        value, cast = F.col(name), "timestamp"
    elif isinstance(kind, T.TimestampNTZType):
        value, cast = F.col(name), "timestamp_ntz"
    else:
        value, cast = try_ts(name), "timestamp_ntz"
    lo = F.lit(f"{int(first):04d}-01-01").cast(cast)
    hi = F.lit(f"{int(last) + 1:04d}-01-01").cast(cast)
    return (value >= lo) & (value < hi)


def search(df: DataFrame, query: str, cols: list[str], year_col: str | None = None) -> DataFrame:
    """Rows in which any of the columns (or the year as text) contains the query, ignoring case."""
    q = (query or "").lower()
    if not q:
        return df
    hits = [F.coalesce(F.lower(F.col(quoted(c))).contains(q), F.lit(False)) for c in cols if c in df.columns]
    if year_col and year_col in df.columns:
        hits.append(F.coalesce(F.col(quoted(year_col)).cast("string").contains(q), F.lit(False)))
    return df.where(reduce(or_, hits)) if hits else df


def any_in(values: Column | str, wanted: Iterable[str] | None) -> Column:
    """Does the array hold any wanted value?"""
    wanted = list(wanted or [])
    if not wanted:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(col_of(values), F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def any_like(values: Column | str, wanted: Iterable[str] | None) -> Column:
    """Does any array item contain any wanted text, brackets and quotes at the ends aside?"""
    bare = [str(w).strip().strip("[]'\"") for w in wanted or []]
    if not bare:
        return F.lit(True)

    def hit(item: Column) -> Column:
        text = F.regexp_replace(item, r"""(?U)^\s*[\[\]'"]*|[\[\]'"]*\s*$""", "")
        return reduce(or_, [text.contains(w) for w in bare])

    return F.coalesce(F.exists(col_of(values), hit), F.lit(False))


def has_coordinates(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def drop_zero_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Drop rows at exactly (0, 0); rows without coordinates stay."""
    at_zero = F.coalesce((F.col(lat) == 0) & (F.col(lon) == 0), F.lit(False))
    return df.where(~at_zero)


def not_future(df: DataFrame, ts: str, as_of: str | None = None) -> DataFrame:
    """Rows dated up to `as_of` (default: now); undated rows go, as they compare false."""
    bound = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return df.where(try_ts(ts) <= bound)


def drop_uninformative(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows whose factor columns are all null or 'unspecified'."""
    return df.where(~F.forall(F.array(*[F.col(quoted(c)) for c in cols]), is_unspecified))


def group_rows(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(quoted(key)) == F.lit(value))


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that do not); a null predicate does not pass."""
    passed = F.coalesce(predicate, F.lit(False))
    return df.where(passed), df.where(~passed)


#: Ranks of rows lie below this: twelve hexadecimal digits of a digest.
RANKS = 16**12


def key_rank(df: DataFrame, key: list[str], seed: int) -> Column:
    """A uniform number below RANKS from the key's columns and the seed; equal keys have equal ranks."""
    values = F.concat_ws("|", F.lit(str(seed)), *[F.col(quoted(k)).cast("string") for k in key])
    return F.conv(F.substring(F.md5(values), 1, 12), 16, 10).cast("bigint")


def sample(df: DataFrame, fraction: float | None, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """A sample of the rows; a fraction outside (0, 1) keeps all.

    With `key` a row is kept if the rank of its key is below the fraction: the
    same rows on any layout of the table, all rows of a key or none, and a
    larger fraction keeps what a smaller one kept. Without key the rows are
    drawn by their place, which is cheaper and differs with the layout.
    """
    if not fraction or not 0 < fraction < 1:
        return df
    if key:
        return df.where(key_rank(df, key, seed) < int(fraction * RANKS))
    return df.sample(fraction=fraction, seed=seed)


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """n random rows (all of them when there are fewer), the same ones on any cluster.

    Rows are ranked by a hash of `key` and the seed. The rank is uniform, so a
    threshold slightly above n / total keeps the final sort small; should it
    keep too few rows, it is widened until it holds n.
    """
    rank = key_rank(df, key, seed)
    ranked = df.withColumn("_rank", rank)
    span = RANKS
    total = df.count()
    share = min(1.0, (n + 8 * n**0.5 + 64) / total) if total else 1.0
    while share < 1.0 and ranked.where(F.col("_rank") < int(share * span)).limit(n).count() < n:
        share = min(1.0, share * 2)
    kept = ranked if share >= 1.0 else ranked.where(F.col("_rank") < int(share * span))
    return kept.orderBy("_rank", *[F.col(quoted(k)) for k in key]).limit(n).drop("_rank")


@dataclass(frozen=True)
class Filters:
    """Selections shared by all questions. Unset fields do not filter."""

    boroughs: tuple[str, ...] = ()
    years: tuple[int, int] | None = None
    year_set: tuple[int, ...] = ()
    vehicles: tuple[str, ...] = ()
    factors: tuple[str, ...] = ()
    injuries: tuple[str, ...] = ()
    person_types: tuple[str, ...] = ()
    sexes: tuple[str, ...] = ()
    min_age: int | None = None
    max_age: int | None = None
    injured_only: bool = False
    min_injured: int = 0
    facets: dict[str, tuple] = field(default_factory=dict)

    @property
    def empty(self) -> bool:
        return self == Filters()

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows that match every selection that is set."""

        def name(role: str) -> str:
            return resolve(df, role)

        def column(role: str) -> Column:
            return F.col(quoted(name(role)))

        tests: list[Column] = []
        if self.boroughs:
            tests.append(in_set(column("borough"), self.boroughs))
        if self.years:
            tests.append(year_between(df, name("crash_datetime"), *self.years))
        if self.year_set:
            tests.append(years_in(column("year"), self.year_set))
        if self.injuries:
            tests.append(in_text(column("person_injury"), self.injuries))
        if self.person_types:
            tests.append(in_set_ci(column("person_type"), self.person_types))
        if self.sexes:
            tests.append(in_set_ci(column("person_sex"), self.sexes))
        if self.min_age is not None:
            tests.append(to_int(column("person_age")) >= self.min_age)
        if self.max_age is not None:
            tests.append(to_int(column("person_age")) <= self.max_age)
        if self.injured_only:
            tests.append(is_injured(column("person_injury")))
        if self.min_injured:
            tests.append(at_least(column("total_injured"), self.min_injured))
        for labels, single, listed in (
            (self.vehicles, "vehicle_type", "vehicle_types_list"),
            (self.factors, "factor", "factors_list"),
        ):
            if labels and listed in df.columns:
                test = any_in(listed, labels) if single == "vehicle_type" else any_like(listed, labels)
                tests.append(test)
            elif labels:
                tests.append(in_set_ci(column(single), labels))
        for facet, values in self.facets.items():
            tests.append(in_set(column(facet), values))
        for test in tests:
            df = df.where(test)
        return df


def _narrow(selected: tuple, parsed: Iterable | None) -> tuple:
    if parsed is None:
        return selected
    parsed = tuple(parsed)
    return tuple(v for v in selected if v in parsed) if selected else parsed


def intersect_filters(selected: Filters, parsed: dict[str, object], override: bool = False) -> Filters:
    """Combine saved selections with facets read from a text.

    Sets are intersected (a parsed facet fills an empty selection), the year
    range is clamped. An intersection that turns out empty filters nothing.
    With `override` the parsed facet replaces the selection.
    """
    changes: dict[str, object] = {}
    for facet in ("boroughs", "vehicles", "factors", "injuries", "person_types", "sexes"):
        if facet in parsed:
            values = tuple(parsed[facet])
            changes[facet] = values if override else _narrow(getattr(selected, facet), values)
    if "years" in parsed:
        first, last = parsed["years"]
        if selected.years and not override:
            first, last = max(selected.years[0], first), min(selected.years[1], last)
        changes["years"] = (first, last)
    return replace(selected, **changes)
