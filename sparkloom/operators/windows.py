"""Densities, gaps, running sums and alternation along an order within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_density(df: DataFrame, by: str, at: str, half_width: float, name: str = "density") -> DataFrame:
    """df with the number of rows of its group within half_width of its `at`, both ends included; `at` is a number.

    A group is cut into buckets of half_width, and each row counts in its own and both
    neighbouring buckets, so that a hot group spreads over tasks; windows run within a bucket.
    """
    b = F.floor(F.col(at) / F.lit(half_width)).cast("long")
    spread = df.withColumn("__own", b).withColumn("__b", F.explode(F.array(b - 1, b, b + 1)))
    n = f"count(*) OVER (PARTITION BY `{by}`, __b ORDER BY `{at}` RANGE BETWEEN {half_width} PRECEDING AND {half_width} FOLLOWING)"
    return spread.withColumn(name, F.expr(n)).filter("__own = __b").drop("__own", "__b")


def gap_bounds(df: DataFrame, by: str, at: str, limit: Column | None = None, bucket: Column | None = None) -> DataFrame:
    """df with gap_before, gap_after and gap_bound, the least of both and the limit; missing neighbours don't bound.

    With `bucket` (a coarser, monotone function of `at`) a hot group is many tasks: neighbours beyond a
    bucket's ends come from the least and greatest of the buckets around it, one row each.
    """
    keys, rows = [by], df
    if bucket is not None:
        rows, keys = df.withColumn("__b", bucket), [by, "__b"]
    w = Window.partitionBy(*keys).orderBy(at)
    before, after = F.lag(at).over(w), F.lead(at).over(w)
    if bucket is not None:
        along = Window.partitionBy(by).orderBy("__b")
        ends = rows.groupBy(*keys).agg(F.min(at).alias("__lo"), F.max(at).alias("__hi"))
        ends = ends.select(*keys, F.lag("__hi").over(along).alias("__prev"), F.lead("__lo").over(along).alias("__next"))
        rows = rows.withColumns({"__l": before, "__r": after}).join(ends, keys)
        before, after = F.coalesce("__l", "__prev"), F.coalesce("__r", "__next")
    out = rows.withColumn("gap_before", F.col(at) - before).withColumn("gap_after", after - F.col(at))
    out = out.withColumn("gap_bound", F.least("gap_before", "gap_after", *([limit] if limit is not None else [])))
    return out.drop("__b", "__l", "__r", "__prev", "__next")


def running_sum(df: DataFrame, by: str, at: list[str], value: str, name: str = "running", bucket: Column | None = None) -> DataFrame:
    """df with the sum of its group up to each row. With `bucket` (a coarser, monotone function of the first of `at`) a hot group is many tasks: each bucket gets the sum of those before it."""
    if bucket is None:
        return df.withColumn(name, F.sum(value).over(Window.partitionBy(by).orderBy(*at).rowsBetween(Window.unboundedPreceding, 0)))
    rows = df.withColumn("__b", bucket)
    along = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(by, "__b").agg(F.sum(value).alias("__t")).select(by, "__b", F.coalesce(F.sum("__t").over(along), F.lit(0)).alias("__c"))
    own = F.sum(value).over(Window.partitionBy(by, "__b").orderBy(*at).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, own).join(carried, [by, "__b"]).withColumn(name, F.col(name) + F.col("__c")).drop("__b", "__c")


def spread_in_chord(df: DataFrame, by: list[str], onset: str, pitch: str) -> DataFrame:
    """df with its rank in its chord (by pitch), the chord's size, and the chord's parity along the track."""
    chord = Window.partitionBy(*by, onset)
    out = df.withColumn("chord_rank", F.row_number().over(chord.orderBy(pitch))).withColumn("chord_size", F.count("*").over(chord))
    return out.withColumn("chord_parity", (F.dense_rank().over(Window.partitionBy(*by).orderBy(onset)) - 1) % 2)


def fifo_pairs(df: DataFrame, by: list[str], order: str, is_on: str) -> DataFrame:
    """(by..., open, close): each closing row ends the oldest open row of its group, as values of `order`; closings without an open row are ignored, open rows that never end are left out.

    Without state: the closings before a row that found nothing open are as many as closings ever
    exceeded openings up to it. The m-th closing that counts meets the m-th opening.
    """
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    on = F.col(is_on).cast("int")
    rows = df.select(*by, order, on.alias("__on")).withColumn("__a", F.sum("__on").over(upto)).withColumn("__b", F.sum(1 - F.col("__on")).over(upto))
    rows = rows.withColumn("__m", F.col("__b") - F.greatest(F.lit(0), F.max(F.col("__b") - F.col("__a")).over(upto)))
    counts = F.col("__m") > F.coalesce(F.lag("__m").over(Window.partitionBy(*by).orderBy(order)), F.lit(0))
    closings = rows.withColumn("__c", counts).filter("__on = 0 AND __c").select(*by, F.col("__m").alias("__n"), F.col(order).alias("close"))
    openings = rows.filter("__on = 1").select(*by, F.col("__a").alias("__n"), F.col(order).alias("open"))
    return openings.join(closings, [*by, "__n"]).select(*by, "open", "close")


def largest_at(df: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """One row for each (by, at): the one with the greatest value."""
    return df.groupBy(*by, at).agg(F.max(value).alias(value))


def tempo_segments(tempos: DataFrame, by: str, per_quarter: Column, default: int = 500_000) -> DataFrame:
    """(by, tick, tempo, seconds): seconds at each tempo change. Equal ticks keep the greatest tempo; tick 0 has the default at least."""
    starts = tempos.select(by).distinct().select(by, F.lit(0).cast("long").alias("tick"), F.lit(default).cast("long").alias("tempo"))
    every = largest_at(tempos.select(by, F.col("tick").cast("long").alias("tick"), F.col("tempo").cast("long").alias("tempo")).unionByName(starts), [by], "tick", "tempo")
    w = Window.partitionBy(by).orderBy("tick")
    step = (F.col("tick") - F.lag("tick").over(w)) * F.lag("tempo").over(w) / 1e6 / per_quarter
    return every.withColumn("__s", F.coalesce(step, F.lit(0.0))).withColumn("seconds", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__s")
