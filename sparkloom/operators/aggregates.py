"""Counts in first-seen order, presence and occurrence, rarity, leaks, path rollups, long form, constraint reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, key: str, ordinal: str, k: int | None = None) -> DataFrame:
    """(key, rows, first_seen): most frequent first, ties by first appearance."""
    out = df.groupBy(key).agg(F.count("*").alias("rows"), F.min(ordinal).alias("first_seen")).orderBy(F.desc("rows"), "first_seen")
    return out.limit(k) if k else out


def delimited_counts(df: DataFrame, column: str, separator: str = "|") -> DataFrame:
    """(item, rows) of a column that lists items; empty items don't count."""
    items = df.select(F.explode(F.split(F.col(column), f"\\Q{separator}\\E")).alias("item")).filter("item != ''")
    return items.groupBy("item").agg(F.count("*").alias("rows"))


def counters(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """One row, one pass: how many rows there are, and for how many each test is true."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(t, F.lit(False))).alias(name) for name, t in tests.items()])


def match_rate(df: DataFrame, test: Column) -> Column:
    """The share of rows for which the test is true, 0 of none."""
    return F.coalesce(F.try_divide(F.count_if(test), F.count("*")), F.lit(0.0))


def rare_items(long: DataFrame, row_id: str, item: str, n_rows: int, share: float = 0.01) -> DataFrame:
    """(item, records_present) of items in less than `share` of the rows; an item at just that share isn't among them."""
    return long.groupBy(item).agg(F.countDistinct(row_id).alias("records_present")).filter(F.col("records_present") / F.lit(max(n_rows, 1)) < share)


def long_form(df: DataFrame, row_id: str, item: str) -> DataFrame:
    """(row_id, item, n) of rows that name one item each."""
    return df.groupBy(row_id, item).agg(F.count("*").alias("n"))


def exploded_form(df: DataFrame, row_id: str, pairs: str, item: str = "item", n: str = "n") -> DataFrame:
    """(row_id, item, n) of an array of (k, v)."""
    return df.select(row_id, F.explode(pairs).alias("__p")).select(row_id, F.col("__p.k").alias(item), F.col("__p.v").alias(n))


def presence(long: DataFrame, row_id: str, item: str, n: str, total: int) -> DataFrame:
    """(item, records_present, occurrences, record_fraction as %.8f) of a long form with one row for each id and item."""
    out = long.groupBy(item).agg(F.countDistinct(row_id).alias("records_present"), F.sum(n).alias("occurrences"))
    return out.withColumn("record_fraction", F.format_string("%.8f", F.col("records_present") / F.lit(max(total, 1))))


def rarity(long: DataFrame, row_id: str, item: str, n_rows: int, rare: float = 0.01) -> DataFrame:
    """(row_id, n_items, rarity, rare_items) of a long form: -log10 of the least frequency among a row's items, plus 0.04 an item.

    Frequencies are of rows that have the item, and an item is rare at a frequency of
    `rare` or less; rare items come in order of frequency, then of the item. They come from a partially combined count and are joined back by item;
    a hot item's join partition is for adaptive execution to split.
    """
    freq = long.groupBy(item).agg((F.count("*") / F.lit(n_rows)).alias("__f"))
    met = long.join(freq, item)
    out = met.groupBy(row_id).agg(F.count("*").alias("n_items"), F.min("__f").alias("__m"), F.array_sort(F.collect_list(F.when(F.col("__f") <= rare, F.struct("__f", F.col(item).alias("i"))))).alias("__rare"))
    score = -F.log10(F.greatest(F.col("__m"), F.lit(1.0 / n_rows))) + 0.04 * F.col("n_items")
    return out.select(row_id, "n_items", F.bround(score, 6).alias("rarity"), F.transform("__rare", lambda x: x["i"]).alias("rare_items"))


def leak_audit(df: DataFrame, keys: Sequence[str], split: str) -> DataFrame:
    """(key_name, key, n_splits) for each value of each key that is in more than one split."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key")) for k in keys])
    out = df.select(split, F.explode(pairs).alias("__p")).groupBy("__p.key_name", "__p.key")
    return out.agg(F.countDistinct(split).alias("n_splits")).filter("n_splits > 1")


def prefix_rollup(df: DataFrame, path: str, max_depth: int = 4) -> DataFrame:
    """(depth, prefix, rows): how many paths begin with each of their first 1 to max_depth parts."""
    parts = F.split(F.col(path), "/")
    lead = F.transform(F.sequence(F.lit(1), F.least(F.lit(max_depth), F.size(parts))), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("prefix")))
    return df.select(F.explode(lead).alias("__p")).groupBy("__p.depth", "__p.prefix").agg(F.count("*").alias("rows"))


def family_totals(long: DataFrame, table: DataFrame, row_id: str, item: str, n: str) -> DataFrame:
    """(family, records_present, occurrences); families may overlap. `table` (item, family) is small and broadcast."""
    met = long.join(F.broadcast(table), item)
    return met.groupBy("family").agg(F.countDistinct(row_id).alias("records_present"), F.sum(n).alias("occurrences"))


def exact_median(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """(by..., median): the middle value, or the mean of the two in the middle. Equal values are counted first, so a group is as long as it has different values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*by)
    at = counts.withColumn("__total", F.sum("__n").over(w)).withColumn("__upto", F.sum("__n").over(w.orderBy(value)))
    holds = lambda k: F.min(F.when(F.col("__upto") >= k, F.col(value).cast("double")))
    return at.groupBy(*by).agg(((holds(F.floor((F.col("__total") + 1) / 2)) + holds(F.floor(F.col("__total") / 2) + 1)) / 2).alias(name))


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "size") -> DataFrame:
    """df with the number of rows that share its keys, counted with partial sums and joined back."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(name)), list(keys))


def check(df: DataFrame, all_true: Mapping[str, Column], unique: Sequence[str] = (), n_rows: int | None = None) -> DataFrame:
    """One row: rows, a boolean for each constraint, and `passed`, their conjunction. Unknown is false."""
    aggs = [F.count("*").alias("rows")]
    aggs += [F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True)).alias(name) for name, c in all_true.items()]
    aggs += [(F.count("*") == F.countDistinct(F.col(u))).alias(f"unique_{u}") for u in unique]
    out = df.agg(*aggs)
    tests = [*all_true, *[f"unique_{u}" for u in unique]]
    if n_rows is not None:
        out, tests = out.withColumn("row_count", F.col("rows") == n_rows), [*tests, "row_count"]
    passed = F.lit(True)
    for t in tests:
        passed = passed & F.col(t)
    return out.withColumn("passed", passed)
