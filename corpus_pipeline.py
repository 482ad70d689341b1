"""The corpus pipeline: quality rules, toxicity, near-duplicates, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of documents; a stage
gets what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import common, packing, quality, simhash, toxicity


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive thresholds reject go."""
    return quality.keep_good(docs)


def toxic_patterns(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return simhash.keep_first(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the remaining documents."""
    return packing.packed(docs)


STAGES = [("quality", quality_rules), ("toxicity", toxic_patterns), ("simhash", near_duplicates), ("packing", best_fit)]

#: SQL has no way to state the toxicity grammar, nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.written(docs, f"stage-{name}")
    return docs
