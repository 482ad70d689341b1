"""Columns from untyped text: null-like values, booleans, numbers, keyword tests, number lists and keys.

ANSI mode raises on bad casts, so every cast here is a try_cast. Regular expressions use (?U),
so that white space and words are Unicode's.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that stand for true, and those that stand for nothing.
TRUE = ("1", "true", "t", "yes", "y")
FALSE = ("0", "false", "f", "no", "n", "")
NULLS = ("", "nan", "na", "n/a", "none", "null")


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def norm_text(c: Column | str) -> Column:
    """Runs of white space as one space, trimmed; null as ''."""
    return F.trim(F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), r"(?U)\s+", " "))


def nullish(c: Column | str) -> Column:
    """The normalised text, or null if it stands for nothing."""
    t = norm_text(c)
    return F.when(~F.lower(t).isin(*NULLS), t)


def first_non_null(*cols: Column | str) -> Column:
    """The first of the columns that says something, else ''."""
    return F.coalesce(*[nullish(c) for c in cols], F.lit(""))


def first_existing(df: DataFrame, *names: str) -> Column:
    """The first of the names that is a column of df, whatever its values; null if none is."""
    return next((F.col(f"`{n}`") for n in names if n in df.columns), F.lit(None).cast("string"))


def to_bool(c: Column | str) -> Column:
    """Whether a text stands for true; all else is false."""
    return F.lower(norm_text(c)).isin(*TRUE)


def to_bool_strict(c: Column | str) -> Column:
    """True, false, or null for texts that stand for neither."""
    t = F.lower(norm_text(c))
    return F.when(t.isin(*TRUE), True).when(t.isin(*FALSE), False)


def to_float(c: Column | str, finite: bool = True) -> Column:
    """A number, commas ignored; 0 if it isn't one, or with `finite` if it is NaN or infinite."""
    x = F.regexp_replace(norm_text(c), ",", "").try_cast("double")
    return F.coalesce(F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) if finite else x, F.lit(0.0))


def finite_or_null(c: Column | str) -> Column:
    x = norm_text(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def to_int(c: Column | str) -> Column:
    """A number without its fraction (towards 0), 0 if it isn't one."""
    return F.coalesce(to_float(c).try_cast("long"), F.lit(0).cast("long"))


def folded(c: Column | str) -> Column:
    """The normalised text in lower case."""
    return F.lower(norm_text(c))


def mentions(c: Column | str, terms: Iterable[str]) -> Column:
    """Whether any term occurs in a folded text. Where many lists are looked for, the folded text should be a column of its own."""
    return reduce(lambda a, b: a | b, [_col(c).contains(x.lower()) for x in terms], F.lit(False))


def contains_any(c: Column | str, terms: Iterable[str]) -> Column:
    """Whether any term occurs in the text, letter case aside and not bound to words."""
    return mentions(folded(c), terms)


def parse_numbers(c: Column | str, low: int = 0, high: int = 127, max_digits: int | None = 3) -> Column:
    """The digit runs of a text as ints between low and high; longer runs than max_digits don't count."""
    runs = F.regexp_extract_all(F.coalesce(_col(c).cast("string"), F.lit("")), F.lit(r"([0-9]+)"), F.lit(1))
    if max_digits:
        runs = F.filter(runs, lambda x: F.length(x) <= max_digits)
    return F.filter(F.transform(runs, lambda x: x.try_cast("int")), lambda x: x.between(low, high))


def multiset(numbers: Column) -> Column:
    """Array of (k, v): each distinct value in order, with its count."""
    return F.transform(F.array_sort(F.array_distinct(numbers)), lambda k: F.struct(k.alias("k"), F.size(F.filter(numbers, lambda x: x == k)).alias("v")))


def multiset_text(pairs: Column) -> Column:
    """'k:v;k:v' of a multiset."""
    return F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["k"].cast("string"), p["v"].cast("string"))), ";")


def multiset_from_text(c: Column | str) -> Column:
    """Map of int to int from 'k:v;k:v'; parts that aren't pairs of numbers are left out."""
    parts = F.filter(F.split(norm_text(c), ";"), lambda x: x.rlike(r"^\s*\d+:\d+\s*$"))
    return F.map_from_entries(F.transform(parts, lambda x: F.struct(F.trim(F.split_part(x, F.lit(":"), F.lit(1))).cast("int").alias("k"), F.trim(F.split_part(x, F.lit(":"), F.lit(2))).cast("int").alias("v"))))


def multiset_json(pairs: Column) -> Column:
    """Compact JSON of a multiset, keys in order."""
    return F.to_json(F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"].cast("string"), p["v"]))))


def stem(path: Column | str) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.substring_index(_col(path), "/", -1), r"(?<=.)\.[^.]*$", "")


def key(c: Column | str, length: int | None = None) -> Column:
    """Lower-case letters a-z and digits only."""
    k = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "")
    return F.substring(k, 1, length) if length else k


def short_hash(c: Column, n: int = 20) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def seed64(*parts: Column) -> Column:
    """Unsigned 64-bit seed: the first 8 bytes of the SHA-256 of the parts joined by U+001F."""
    joined = F.concat_ws("\x1f", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def tokens(path: Column | str, noise: Iterable[str] = (), min_part: int = 5) -> Column:
    """Distinct tokens of a path: the canonical name, name parts of min_part letters, and numbers of 5 digits or more without leading zeros."""
    name = canonical(path, noise)
    low = F.lower(_col(path))
    parts = F.filter(F.split(low, r"[^a-z0-9]+"), lambda x: F.length(x) >= min_part)
    numbers = F.filter(F.transform(F.regexp_extract_all(low, F.lit(r"(\d{5,})"), F.lit(1)), lambda x: F.ltrim(x, F.lit("0"))), lambda x: x != "")
    return F.array_distinct(F.filter(F.concat(F.array(name), parts, numbers), lambda x: x != ""))


def canonical(path: Column | str, noise: Iterable[str] = ()) -> Column:
    """The key of a path's name without suffixes and without one noise affix at its start and end."""
    name = F.regexp_replace(F.lower(F.substring_index(_col(path), "/", -1)), r"(?<=.)(\.[a-z0-9]{1,5})+$", "")
    words = "|".join(noise)
    if words:
        name = F.regexp_replace(F.regexp_replace(name, rf"^(?:{words})[_\- ]+", ""), rf"[_\- ]+(?:{words})$", "")
    return F.regexp_replace(name, "[^a-z0-9]+", "")


def json_ints(numbers: Column) -> Column:
    """Compact JSON of an array of ints, '[]' for null."""
    return F.coalesce(F.to_json(numbers), F.lit("[]"))


def instant(c: Column | str) -> Column:
    """A timestamp of ISO 8601 text, null if it isn't one."""
    return F.try_to_timestamp(norm_text(c))


def iso_now() -> Column:
    """The time of the query in UTC as ISO 8601 text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from one ISO 8601 text to another, null if either isn't one."""
    at = lambda c: F.unix_micros(instant(c))
    return (at(end) - at(start)) / 1e6


def sql_text(value: str) -> str:
    """A text as a SQL literal. Where a query can take parameters (spark.sql(args=...)) those are to be preferred."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
