"""The operators applied to the tables they are meant for: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regforge.llm.code_switch import languages
from regforge.llm.common import table
from regforge.llm.conversation_repair import repair_damaged
from regforge.llm.decontaminate import contaminated_documents
from regforge.llm.exact_dedup import exact_dedup
from regforge.llm.hard_negatives import hard_negatives
from regforge.llm.language_model import score_held_out
from regforge.llm.mixing import mix
from regforge.llm.near_dedup import near_duplicates
from regforge.llm.quality import quality
from regforge.llm.sharding import kd_shards
from regforge.llm.toxicity import toxicity
from regforge.llm.transcripts import parse_conversations
from regforge.llm.url_filter import judge_urls


def op1_url_language_models(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


def op2_additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return kd_shards(table(spark, folder, "documents"))


def op4_noisy_channel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op7_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_pareto_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


def op9_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return score_held_out(table(spark, folder, "documents"))


def op10_transcript_parsing(spark: SparkSession, folder: str) -> DataFrame:
    return parse_conversations(table(spark, folder, "conversations"))


def op11_code_switch_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_damaged(table(spark, folder, "conversations"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_language_models,
        op2_additive_quality,
        op3_kd_sharding,
        op4_noisy_channel_toxicity,
        op5_minhash_near_dedup,
        op6_exact_dedup,
        op7_template_decontamination,
        op8_pareto_mixing,
        op9_kneser_ney,
        op10_transcript_parsing,
        op11_code_switch_language,
        op12_conversation_repair,
        op13_hard_negatives,
    )
}
