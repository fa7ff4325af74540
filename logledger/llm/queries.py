"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logledger.llm import chat, decontaminate, hosts, phrases, warc
from logledger.llm.packing import packing_digest
from logledger.llm.periodic import periodic_digest
from logledger.llm.quality_rules import quality_verdicts
from logledger.llm.repeats import repeats_digest
from logledger.llm.secrets import find_secrets
from logledger.llm.simhash import near_duplicates
from logledger.llm.token_counts import token_counts
from logledger.llm.token_files import token_file_digest

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("item_ids")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(table(spark, sf_dir, "conversations"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge_urls(table(spark, sf_dir, "pages"), hosts.rule_table(spark))
    return judged.drop("trust", "distrust")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("span_list")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_digest(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()
    }


def llm_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontaminate.SQL,
        "op3_chat": chat.SQL,
        "op6_url_filter": hosts.sql(),
        "op9_warc": warc.SQL,
        "op11_phrases": phrases.SQL,
    }
