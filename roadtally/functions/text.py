"""Text labels and list-in-a-cell columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# The five boroughs' display names.
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that count as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Drop white space of any kind at both ends (plain `trim` drops blanks only)."""
    return F.trim(col_of(c), F.lit(WHITE_SPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def clean_text(c: Column | str) -> Column:
    """Stripped and lower-cased; null stays null."""
    return F.lower(strip(c))


def label(c: Column | str, null_if: str = UNKNOWN) -> Column:
    """Trimmed label; null, or a value equal to `null_if`, reads 'Unknown'.

    With `null_if='Unknown'` a blank stays a group of its own, with
    `null_if=''` a blank counts as unknown.
    """
    return F.coalesce(F.nullif(F.trim(col_of(c)), F.lit(null_if)), F.lit(UNKNOWN))


def label_equipment(c: Column | str, blank_as_unknown: bool = True) -> Column:
    """Equipment label without brackets, trimmed and lower-cased."""
    bare = F.lower(F.trim(F.translate(F.coalesce(col_of(c), F.lit("")), "[]", "")))
    if not blank_as_unknown:
        return bare
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(UNKNOWN))


def normalize_borough(c: Column | str) -> Column:
    """'BROOKLYN ' -> 'Brooklyn'; null and blank -> 'Unknown'."""
    titled = F.initcap(clean_text(c))
    return F.coalesce(F.nullif(titled, F.lit("")), F.lit(UNKNOWN))


def clean_label(c: Column | str) -> Column:
    """Drop brackets and stray punctuation, squeeze white space.

    Letters of any script, digits, `_`, white space and `- / , &` stay.
    """
    bare = F.regexp_replace(col_of(c), r"[\[\](){}<>]", "")
    bare = F.regexp_replace(bare, r"(?U)[^\w\s\-/,&]", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def clean_list(c: Column | str) -> Column:
    """Comma text with each part cleaned and empty parts dropped."""
    parts = F.transform(F.split(col_of(c), ","), clean_label)
    return F.array_join(F.filter(parts, lambda p: p != ""), ",")


def split_clean(c: Column | str, drop_blank: bool = True) -> Column:
    """Comma text -> trimmed array; null counts as ''."""
    parts = F.transform(F.split(F.coalesce(col_of(c), F.lit("")), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "") if drop_blank else parts


def unique_labels(values: Column | str) -> Column:
    """Cleaned, distinct, sorted labels of an array column."""
    cleaned = F.transform(F.filter(col_of(values), lambda v: strip(v) != ""), clean_label)
    return F.array_sort(F.array_distinct(cleaned))


def parse_list(c: Column | str) -> Column:
    """List text -> array<string>, items stripped, blank items dropped.

    A bracketed (or quoted, comma-separated) literal is read as a list. A text
    that is a literal of another kind - a number, one quoted string, None or a
    boolean - gives an empty list. Other text is split on the first of
    `, ; |` that occurs in it, or is a single item.
    """
    items = let(strip(c), _list_items)
    return F.filter(F.transform(items, strip), lambda v: v != "")


def _list_items(text: Column) -> Column:
    quoted = r"""(?:'[^'\\]*'|"[^"\\]*")"""
    is_list = text.rlike(r"(?s)^\[.*\]$") | text.rlike(r"(?s)^\(.*,.*\)$") | text.rlike(
        rf"^{quoted}\s*,(?:\s*{quoted}\s*,)*(?:\s*{quoted})?$"
    )
    is_other_literal = text.rlike(
        rf"^(?:[-+]?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?|{quoted}|\({quoted}\)|\(\)|None|True|False)$"
    )
    bracketed = F.when(text.rlike(r"""^['"]"""), F.concat(F.lit("["), text, F.lit("]"))).otherwise(
        F.regexp_replace(text, r"(?s)^\((.*)\)$", "[$1]")
    )
    literal = F.from_json(F.regexp_replace(bracketed, r",\s*\]$", "]"), "array<string>", {"allowSingleQuotes": "true"})
    # A text of separators only has no part, so it stands for itself.
    separated = (
        F.when(~text.rlike(r"[^,;|\s]"), F.array(text))
        .when(text.contains(","), F.split(text, ","))
        .when(text.contains(";"), F.split(text, ";"))
        .when(text.contains("|"), F.split(text, r"\|"))
        .otherwise(F.array(text))
    )
    return (
        F.when(text.isNull() | is_other_literal, F.array().cast("array<string>"))
        .when(is_list, let(literal, lambda v: F.coalesce(v, separated)))
        .otherwise(separated)
    )


def or_unknown(values: Column) -> Column:
    """An empty or null list becomes ['Unknown']."""
    return let(values, lambda v: F.when(F.size(v) > 0, v).otherwise(F.array(F.lit(UNKNOWN))))


def collect_labels(cols: list[str], drop: tuple[str, ...]) -> Column:
    """Array of the columns' values without nulls and the `drop` placeholders."""
    return F.filter(F.array(*[F.col(c) for c in cols]), lambda v: v.isNotNull() & ~v.isin(*drop))


def join_labels(values: Column, empty: str = "none") -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(F.lit(empty))


def contains_ci(c: Column | str, needle: str) -> Column:
    return F.lower(col_of(c)).contains(needle.lower())


def is_digits(c: Column | str) -> Column:
    return F.coalesce(col_of(c).rlike("^[0-9]+$"), F.lit(False))


def map_values(c: Column | str, mapping: dict[str, str], default: Column | str | None = None) -> Column:
    """Exact replace by a fixed mapping.

    `default` is a column or text for values outside the mapping; without one
    they stay as they are. The mapping is a literal of the plan, so no join.
    """
    value = col_of(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, value)
    if default is None:
        return F.coalesce(found, value)
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def lookup_label(c: Column | str, labels: dict[str, str], default: str) -> Column:
    """Label for a lower-cased key, else `default`."""
    return map_values(clean_text(c), labels, default)


def is_injured(c: Column | str) -> Column:
    """True for a value that is neither null nor one of the 'not injured' words."""
    # Words that mean "not injured".
    words = ("no injury", "none", "unknown", "")
    return F.coalesce(~F.lower(F.trim(col_of(c))).isin(*words), F.lit(False))


def is_fatal(c: Column | str) -> Column:
    return F.coalesce(F.lower(col_of(c)).rlike("kill|fatal"), F.lit(False))
