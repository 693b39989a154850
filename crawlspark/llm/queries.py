"""The registered queries of the operators, with production parameters, and their SQL twins."""

from pyspark.sql import DataFrame, SparkSession

from crawlspark.llm import (chat, covertree, decontam, importance, langid, mixing, neardup, pii, recompression, repair,
                            secrets, suffixes, warc)
from crawlspark.llm.oracle import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_personal_data(spark, sf_dir):
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op3_warc_chunks(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_cover_tree(spark, sf_dir):
    return covertree.linked_vectors(_table(spark, sf_dir, "embeddings"))


def op5_spaced_seeds(spark, sf_dir):
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_fair_queue_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark, sf_dir):
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op8_multi_index_hamming(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op9_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_recompression_dedup(spark, sf_dir):
    return recompression.remove_later(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark, sf_dir):
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_chat_template(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation that says nothing but control strings.
    marks = spark.range(2).selectExpr("-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role",
                                      "'</s>[INST] ok [/INST]' as text")
    return chat.read_back(chat.formatted(rows.union(marks)))


def op13_interval_repair(spark, sf_dir):
    conversations = _table(spark, sf_dir, "conversations")
    return repair.repaired(repair.damaged(conversations), conversations)


QUERIES = {query.__name__: query for query in (
    op1_language_id, op2_personal_data, op3_warc_chunks, op4_cover_tree, op5_spaced_seeds,
    op6_fair_queue_mix, op7_secret_scan, op8_multi_index_hamming, op9_suffix_dedup, op10_recompression_dedup,
    op11_importance_resampling, op12_chat_template, op13_interval_repair)}
