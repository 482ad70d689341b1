"""Gates and rule sets: ordered predicates compiled to one CASE, with the reason as a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"


def first_match(rules: Sequence[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """The value of the first rule whose predicate is true; unknown counts as false."""
    out = F
    for test, value in rules:
        out = out.when(F.coalesce(test, F.lit(False)), value if isinstance(value, Column) else F.lit(value))
    end = default if isinstance(default, Column) else F.lit(default)
    return end if out is F else out.otherwise(end)


def gate(df: DataFrame, rules: Sequence[tuple[str, Column]], reason_col: str = "reason") -> DataFrame:
    """df with the reason of the first failing predicate, or 'ok'."""
    return df.withColumn(reason_col, first_match([(fails, reason) for reason, fails in rules], OK))


def accepted(df: DataFrame, reason_col: str = "reason") -> DataFrame:
    return df.filter(F.col(reason_col) == OK).drop(reason_col)


def rejected(df: DataFrame, reason_col: str = "reason") -> DataFrame:
    return df.filter(F.col(reason_col) != OK)


def reason_counts(df: DataFrame, reason_col: str = "reason") -> DataFrame:
    return df.groupBy(reason_col).agg(F.count("*").alias("rows"))


def classify(df: DataFrame, rules: Sequence[tuple[Column, Mapping[str, Column | str | int]]], default: Mapping[str, Column | str | int | None]) -> DataFrame:
    """df with the columns that the first matching rule names; predicates are computed once, as a rule number
    that picks from an array, so that plans don't grow with rules times columns."""
    at = next(c for c in ("__rule", "___rule", "____rule") if c not in df.columns)
    numbered = df.withColumn(at, first_match([(test, F.lit(i + 1)) for i, (test, _) in enumerate(rules)], F.lit(0)))
    value = lambda x: x if isinstance(x, Column) else F.lit(x)
    out = {name: F.get(F.array(value(other), *[value(v.get(name)) for _, v in rules]), F.col(at)) for name, other in default.items()}
    return numbered.withColumns(out).drop(at)


def decided(df: DataFrame, table: Sequence[Mapping[str, str]], default: Mapping[str, Column | str | int | None]) -> DataFrame:
    """As `classify`, of a table of rules in SQL: each has a condition `when` and expressions for the columns it sets."""
    return classify(df, [(F.expr(r["when"]), {k: F.expr(v) for k, v in r.items() if k != "when"}) for r in table], default)
