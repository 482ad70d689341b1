"""The queries of this subpackage, each over its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, licenses, lm_scoring, media, packing, quality, simhash, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op1(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op2(_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.op3(_table(spark, sf_dir, "documents"))


def op4_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.op4(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op5(_table(spark, sf_dir, "documents"))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op6(_table(spark, sf_dir, "conversations"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.op7(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op8(_table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op9(_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op10(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    own = [op1_toxicity, op2_quality_rules, op3_lm_scoring, op4_telephony_audio, op5_license_scan, op6_preference_format, op7_bpe, op8_warc, op9_simhash, op10_best_fit_packing, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality.ORACLE, "op5_license_scan": licenses.oracle(), "op6_preference_format": chat.ORACLE, "op8_warc": warc.ORACLE}
