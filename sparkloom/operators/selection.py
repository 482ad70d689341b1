"""Ranking, deduplication, capped selection, representatives and allocation.

No step orders all rows in one task: limits are distributed top-k, and numbers in
global order come from range-partitioned sorts with offsets for each partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row in `order` for each value of the keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_packed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As `dedup` with ascending order columns, by a min of structs: combined before the shuffle, so a hot key costs one row a task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def canonical_flag(df: DataFrame, hash_col: str, order_col: str, flag: str = "is_canonical") -> DataFrame:
    """df with a flag on the row with the least order_col of each hash."""
    least = df.groupBy(hash_col).agg(F.min(order_col).alias("__least"))
    return df.join(least, hash_col).withColumn(flag, F.col(order_col) == F.col("__least")).drop("__least")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """df with 1, 2, 3 ... in the given order, which should be total.

    Rows are sorted by range partitions and written; each partition then gets the
    number of rows before it, from a list as long as there are partitions.
    """
    at = written(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    counts = sorted((r[0], r[1]) for r in at.groupBy(F.shiftrightunsigned("__at", 33)).count().collect())
    before = dict(zip([p for p, _ in counts], [0, *accumulate(n for _, n in counts)], strict=False))
    if not before:
        return at.withColumn(name, F.lit(0).cast("long")).drop("__at")
    offsets = df.sparkSession.createDataFrame(list(before.items()), "__part long, __before long")
    out = at.withColumn("__part", F.shiftrightunsigned("__at", 33)).join(F.broadcast(offsets), "__part")
    return out.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at", "__part", "__before")


def capped_select(df: DataFrame, group: str, order: Sequence[Column], caps: Sequence[int | None] = (3, 10, None), target: int = 5000) -> DataFrame:
    """At most `target` rows: first up to caps[0] of each group in order, then up to caps[1] and so on.

    Adds `stage` (index of the cap that let the row in). The last step is a distributed top-k.
    """
    k = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    stage = F
    for i, cap in enumerate(caps):
        stage = stage.when(F.lit(True) if cap is None else F.col("__k") <= cap, i)
    out = df.withColumn("__k", k).withColumn("stage", stage).filter("stage IS NOT NULL")
    return out.orderBy("stage", *order).limit(target).drop("__k")


def representative(df: DataFrame, cluster: str, order: Sequence[Column]) -> DataFrame:
    return dedup(df, [cluster], order)


def allocate(reps: DataFrame, cluster: str, ranked: Sequence[tuple[str, int, Sequence[Column]]], hashed: Sequence[tuple[str, int]], rest: str = "train") -> DataFrame:
    """(cluster, split): disjoint top-n picks, one bucket after the other, from what the earlier ones left.

    `ranked` buckets take rows by their order, `hashed` ones by sha256(name|cluster);
    a bucket's picks are a list of the size the caller asked for. Raises if there are too few clusters.
    """
    wanted = sum(n for _, n, _ in ranked) + sum(n for _, n in hashed)
    if reps.count() < wanted:
        raise ValueError(f"fewer than {wanted} clusters")
    left, picks = reps, []
    orders = [(name, n, list(order)) for name, n, order in ranked]
    orders += [(name, n, [F.sha2(F.concat(F.lit(f"{name}|"), F.col(cluster).cast("string")), 256)]) for name, n in hashed]
    for name, n, order in orders:
        took = written(left.orderBy(*order).limit(n).select(cluster).withColumn("split", F.lit(name)), "picks")
        picks.append(took)
        left = left.join(took.select(cluster), cluster, "left_anti")
    return reduce(DataFrame.unionByName, picks, left.select(cluster).withColumn("split", F.lit(rest)))


def prefix(df: DataFrame, order: Sequence[Column], n: int = 100) -> DataFrame:
    """The first n rows in order: a distributed top-n."""
    return df.orderBy(*order).limit(n)


def drawn(df: DataFrame, share: float, seed: int, replace: bool = True) -> DataFrame:
    """A seeded random sample, by default with replacement, of about `share` of the rows; the same for the same rows in the same partitions."""
    return df.sample(withReplacement=replace, fraction=share, seed=seed)


def first_samples(df: DataFrame, split: str, order: Sequence[Column], n: int | None, column: str = "split") -> DataFrame:
    """The rows of a split, or the first n of them: what a training run reads."""
    rows = df.filter(F.col(column) == split)
    return rows if n is None else prefix(rows, order, n)


def at_least(df: DataFrame, n: int, what: str = "rows", exact: bool = False) -> DataFrame:
    """df, if it has n rows at least (or, with `exact`, just n); else raises ValueError."""
    found = df.count()
    if found < n or exact and found != n:
        raise ValueError(f"{found} {what}, {'not' if exact else 'fewer than'} {n}")
    return df
