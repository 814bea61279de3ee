"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefmill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.token_frames import token_output

    return token_output(table(spark, sf_dir, "documents"))


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), keep_ids=False)


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.chat import formatted_digests

    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return formatted_digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.media import media_columns

    return media_columns(table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.license_scan import licenses

    return licenses(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.fertility import quality

    return quality(table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prefmill.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {"op1_bpe": _op1, "op2_chat": _op2, "op3_toxicity": _op3, "op4_simhash": _op4, "op5_best_fit_packing": _op5, "op6_url_filter": _op6, "op7_media": _op7, "op8_license_scan": _op8, "op9_fertility": _op9, "op10_token_frames": _op10}


def oracle_sql() -> dict[str, str]:
    from prefmill.llm.chat import digest_sql

    return {"op2_chat": digest_sql()}
