"""The queries of this subpackage over the given tables, and their checks in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment,
    conversations,
    decontamination,
    html_text,
    mixing,
    near_duplicates,
    ngram_join,
    pii,
    quality_rules,
    recurrent_lm,
    secrets,
    site_quality,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nearest_examples(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_digest(table(spark, folder, "documents"))


def op3_recurrent_scores(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, folder, "documents"))


def op4_weighted_fair_queueing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def op5_qgram_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_tensored_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), width=4)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_rules.fit_quality(docs, table(spark, folder, "labels"))
    return quality_rules.judge_quality(docs, model)


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data_digest(table(spark, folder, "documents"))


def op9_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, folder, "pages"))


def op10_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.site_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.trie_digest(table(spark, folder, "conversations"))


def op12_multiple_order_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.cross_tokenizer_alignment(table(spark, folder, "documents"))


_QUERIES = (
    op1_nearest_examples,
    op2_secret_ownership,
    op3_recurrent_scores,
    op4_weighted_fair_queueing,
    op5_qgram_decontamination,
    op6_tensored_minhash,
    op7_quality_rules,
    op8_personal_data,
    op9_site_templates,
    op10_site_quality,
    op11_conversation_trie,
    op12_multiple_order_join,
    op13_tokenizer_alignment,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_weighted_fair_queueing": mixing.MIX_SQL}
