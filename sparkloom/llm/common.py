"""Helpers shared by the training-data operators: shared-folder tables, session checks, skew-proof joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship, written

#: Characters that separate words, and the pattern of a word, in Java's and Python's syntax alike.
SPACES = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one Arrow batch carries to Python at most; bounds a worker's memory on long texts.
BATCH_ROWS = 2000


def session(df: DataFrame) -> SparkSession:
    """The session of a DataFrame, with Arrow batches held to BATCH_ROWS."""
    spark = df.sparkSession
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hidden(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame doesn't have."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        c = f"__{n}"
        while c.lower() in have:
            c = f"_{c}"
        have.add(c.lower())
        out.append(c)
    return out


def hot_keys(counts: DataFrame, key: str, count: str, n_rows: int, parts: int) -> list:
    """Keys that hold more than 1/(4 * parts) of n_rows; so there are fewer than 4 * parts of them."""
    least = max(1000, n_rows // (4 * parts))
    return [r[0] for r in counts.filter(F.col(count) > least).select(key).collect()]


def salted_left_join(big: DataFrame, small: DataFrame, key: str, hot: list, by: str, salts: int = 32) -> DataFrame:
    """big LEFT JOIN small on key, where rows of the hot keys go to as many as `salts` tasks.

    `small` has one row per key; the few hot ones are repeated for each salt.
    `by` is the column of `big` that deals its hot rows out. Null keys match nothing.
    `small` grows with the data, and well compressed files look smaller than they are: it is never broadcast.
    """
    (salt,) = hidden(big, "salt")
    if not hot:
        return big.join(small.hint("merge"), key, "left")
    is_hot = F.col(key).isin(hot)
    dealt = big.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(F.lit("salt"), by), F.lit(salts))).otherwise(F.lit(0).cast("long")))
    spread = small.withColumn(salt, F.explode(F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))))
    return dealt.join(spread.hint("merge"), [key, salt], "left").drop(salt)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
