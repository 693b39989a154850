"""Training corpus from `documents`: stages applied one after the other, each on all its predecessor kept."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlspark.llm import decontam, langid, mixing, neardup, pii
from crawlspark.llm.shared import scratch_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null and letterless texts go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: five-word shingles, similarity 0.8."""
    return neardup.keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of `benchmark`."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked in their texts."""
    return pii.mask_personal_data(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with `repeats`, how often each is used."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

# Languages and near duplicates come from a trained model and from shingle sets over whole tables: tested otherwise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}-{name}")
        docs = spark.read.parquet(f"{folder}/{place}-{name}")
    return docs
