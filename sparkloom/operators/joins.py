"""Joins that plain equality doesn't say: unambiguous lookups, token overlap, prefixes, as-of, first interval, header columns, siblings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .selection import numbered

#: Distinct prefixes or intervals that are broadcast at most; more are joined by equality on depth or time bucket.
BROADCAST_ROWS = 10_000


def unambiguous_lookup(left: DataFrame, right: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """left with the value of its key in right, where that key has one value only; else the default, with `matched` false."""
    build = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("__v"), F.max(value).alias("__w"))
    build = build.filter(F.col("__v") == F.col("__w")).select(key, "__v")
    out = left.join(build, key, "left")
    return out.withColumn("matched", F.col("__v").isNotNull()).withColumn(value, F.coalesce("__v", default)).drop("__v")


def token_match(left: DataFrame, right: DataFrame, weight: int = 5, unique_only: bool = False) -> DataFrame:
    """Best right id for each left id by weighted token overlap.

    left: (id, name, tokens); right: (id, name, tokens); tokens are arrays. A shared token
    counts `weight` if it is the left row's name, else 1. A single best id is the match
    ('token'); if the best tie, the one candidate whose name equals the left name
    ('name'), if there is just one; else none ('ambiguous'; 'none' without candidates).
    With unique_only the name goes first. Only tokens that occur on the right side leave the left
    side, and pairs are summed as they meet.
    """
    rt = right.select(F.col("id").alias("rid"), F.col("name").alias("rname"), F.explode(F.array_distinct("tokens")).alias("t"))
    lt = left.select(F.col("id").alias("lid"), F.col("name").alias("lname"), F.explode(F.array_distinct("tokens")).alias("t"))
    lt = lt.join(rt.select("t").distinct(), "t", "left_semi")
    score = F.sum(F.when(F.col("t") == F.col("lname"), weight).otherwise(1)).alias("score")
    pairs = lt.join(rt, "t").groupBy("lid", "rid").agg(score, F.max(F.col("lname") == F.col("rname")).alias("same"))
    top = pairs.groupBy("lid").agg(
        F.max("score").alias("score"),
        F.max_by("rid", "score").alias("best"),
        F.count(F.when(F.col("same"), 1)).alias("n_same"),
        F.max(F.when(F.col("same"), F.col("rid"))).alias("by_name"),
    )
    ties = pairs.join(top.select("lid", "score"), ["lid", "score"]).groupBy("lid").agg(F.count("*").alias("n_best"))
    out = left.select(F.col("id").alias("lid")).join(top.join(ties, "lid"), "lid", "left")
    single, named = F.col("n_best") == 1, F.col("n_same") == 1
    order = [(named, "by_name", "name"), (single, "best", "token")] if unique_only else [(single, "best", "token"), (named, "by_name", "name")]
    match, how = F, F.when(F.col("n_best").isNull(), "none")
    for test, col, name in order:
        match, how = match.when(test, F.col(col)), how.when(test, name)
    return out.select("lid", match.alias("rid"), how.otherwise("ambiguous").alias("method"), F.when(match.isNotNull(), F.col("score")).alias("score"))


def prefix_join(left: DataFrame, prefixes: DataFrame, path: str, prefix: str, separator: str = "/") -> DataFrame:
    """left rows with each prefix that is their path or a leading part of it, cut at separators.

    An equality join: each path is exploded to its own leading parts, so no rows are compared
    that don't match.
    """
    parts = F.split(F.col(path), separator)
    lead = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), separator))
    return left.withColumn(prefix, F.explode(lead)).join(prefixes.select(prefix).distinct(), prefix)


def header_join(rows: DataFrame, headers: DataFrame, by: str, number: str, suffix: str = "_tstamp") -> DataFrame:
    """rows joined with the columns named <number><suffix> of their file; headers has (by, header array). Adds `alignment_column`."""
    names = headers.select(by, F.explode("header").alias("alignment_column")).filter(F.col("alignment_column").endswith(suffix))
    names = names.withColumn(number, F.regexp_replace("alignment_column", f"{suffix}$", "")).dropDuplicates([by, number])
    return rows.join(names, [by, number])


def asof_join(left: DataFrame, right: DataFrame, on: str, by: str, values: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """left with the values of the last right row of the same `by` whose `on` isn't later.

    Of right rows at one time the greatest values win. With `bucket` (a coarser, monotone
    function of `on` as a column of both) a hot `by` is split among tasks: windows run within a bucket,
    and the last row before each bucket is carried over, from one row a bucket.
    """
    pack = F.struct(F.col(on).alias("o"), F.struct(*values).alias("v"))
    both = left.withColumn("__side", F.lit(1)).withColumn("__r", F.lit(None).cast(right.select(pack.alias("x")).schema["x"].dataType))
    lone = right.groupBy(by, on).agg(F.max(F.struct(*values)).alias("__v")).select(by, on, F.struct(F.col(on).alias("o"), F.col("__v").alias("v")).alias("__r"), F.lit(0).alias("__side"))
    both = both.unionByName(lone, allowMissingColumns=True)
    keys = [by]
    if bucket is not None:
        both, keys = both.withColumn("__b", bucket), [by, "__b"]
    w = Window.partitionBy(*keys).orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__last", F.last("__r", ignorenulls=True).over(w))
    if bucket is not None:
        tail = both.groupBy(*keys).agg(F.max("__r").alias("__end"))
        before = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        tail = tail.withColumn("__carry", F.last("__end", ignorenulls=True).over(before)).drop("__end")
        out = out.join(tail, keys).withColumn("__last", F.coalesce("__last", "__carry"))
    out = out.filter("__side = 1")
    return out.select(*left.columns, *[F.col(f"__last.v.{v}").alias(f"last_{v}") for v in values], F.col("__last.o").alias(f"last_{on}"))


def _pieces(intervals: DataFrame, start: str, end: str, ordinal: str, value: str) -> DataFrame:
    """(x, value): from each bound x to the next, the value of the first interval that covers it, or null.

    Bounds are numbered, and each interval is cut into the few aligned runs of 1, 2, 4 ...
    numbers that make it up; a piece meets the runs it lies in by equality, one for each power of two.
    """
    spans = intervals.select(F.col(start).alias("__s"), F.col(end).alias("__e"), F.col(ordinal).alias("__k"), F.col(value).alias("__v")).filter("__s < __e")
    bounds = numbered(spans.select(F.col("__s").alias("x")).union(spans.select("__e")).distinct(), [F.col("x")], "__i").withColumn("__i", F.col("__i") - 1)
    levels = max(1, bounds.count()).bit_length()
    at = lambda c, name: bounds.select(F.col("x").alias(c), F.col("__i").alias(name))
    spans = spans.join(at("__s", "__a"), "__s").join(at("__e", "__b"), "__e").select("__a", "__b", "__k", "__v")

    def runs(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        low, high = F.ceil(F.col("__a") / size), F.floor(F.col("__b") / size)
        left = F.when((low < high) & (low % 2 == 1), F.struct(level.alias("l"), low.alias("c")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(level.alias("l"), (high - 1).alias("c")))
        return F.array(left, right)

    every = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), runs)), lambda x: x.isNotNull())
    cells = spans.select(F.explode(every).alias("__r"), "__k", "__v").groupBy("__r.l", "__r.c").agg(F.min(F.struct("__k", "__v")).alias("__m"))
    up = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda l: F.struct(l.alias("l"), F.floor(F.col("__i") / F.pow(F.lit(2.0), l)).alias("c")))
    met = bounds.select("x", "__i", F.explode(up).alias("__u")).select("x", "__u.l", "__u.c").join(cells, ["l", "c"], "left")
    return met.groupBy("x").agg(F.min("__m").alias("__m")).select("x", F.col("__m.__v").alias(value))


def interval_first(left: DataFrame, intervals: DataFrame, at: str, start: str, end: str, ordinal: str, value: str, default: Column) -> DataFrame:
    """left with the value of the first interval (least ordinal) with start <= at < end, else the default.

    A short list of intervals (checked: BROADCAST_ROWS) becomes one sorted array that is
    broadcast; a longer one is cut at all its bounds into disjoint pieces, each with its
    first interval, and found as-of, in ranges of `at` with about as many rows each.
    """
    n = intervals.count()
    if n <= BROADCAST_ROWS:
        pack = F.struct(F.col(ordinal).alias("k"), F.col(start).alias("a"), F.col(end).alias("b"), F.col(value).alias("v"))
        every = intervals.agg(F.array_sort(F.collect_list(pack)).alias("__all"))
        found = F.get(F.filter("__all", lambda s: (s["a"] <= F.col(at)) & (F.col(at) < s["b"])), F.lit(0))["v"]
        return left.join(F.broadcast(every)).withColumn(value, F.coalesce(found, default)).drop("__all")
    pieces = written(_pieces(intervals, start, end, ordinal, value), "pieces")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = left.select(F.col(at).cast("double").alias("x")).approxQuantile("x", [i / parts for i in range(1, parts)], 0.25 / parts)
    cut = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    bucket = F.size(F.filter(cut, lambda c: c <= F.col(at)))
    one = pieces.select(F.col("x").alias(at), value, F.lit(0).alias("__one"))
    out = asof_join(left.withColumn("__one", F.lit(0)), one, at, "__one", [value], bucket)
    return out.select(*left.columns, F.coalesce(F.col(f"last_{value}"), default).alias(value))


def coalesce_lookup(left: DataFrame, right: DataFrame, keys: Sequence[Column], right_key: str, value: str, default: Column) -> DataFrame:
    """left with the value of the first of several candidate keys that right has, else the default; of several values of a key the least counts."""
    (row,) = ("__row",)
    tagged = left.withColumn(row, F.struct(*left.columns)).withColumn("__keys", F.array(*keys))
    table = right.groupBy(right_key).agg(F.min(value).alias("__v"))
    out = tagged
    for i in range(len(keys)):
        out = out.join(table.select(F.col(right_key).alias(f"__k{i}"), F.col("__v").alias(f"__v{i}")), F.get("__keys", F.lit(i)) == F.col(f"__k{i}"), "left")
    return out.select(*[F.col(f"{row}.{c}").alias(c) for c in left.columns], F.coalesce(*[F.col(f"__v{i}") for i in range(len(keys))], default).alias(value))


def siblings(files: DataFrame, primary: str, required: Sequence[str] = (), optional: Sequence[str] = ()) -> DataFrame:
    """Files (path) with suffix `primary`, with the paths of same-named files of other suffixes in the folder; required ones must exist."""
    cut = lambda s: F.expr(f"left(path, length(path) - {len(s)})")
    out = files.filter(F.col("path").endswith(primary)).select("path", cut(primary).alias("__stem"))
    for s in (*required, *optional):
        other = files.filter(F.col("path").endswith(s)).select(cut(s).alias("__stem"), F.col("path").alias(s.strip(".").replace(".", "_")))
        out = out.join(other, "__stem", "inner" if s in required else "left")
    return out.drop("__stem")
