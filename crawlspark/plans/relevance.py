"""Relevance plans: from pages and a knowledge base to ranked pages and hosts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.urls import host
from crawlspark.operators.dedup import one_text_per_url
from crawlspark.operators.records import plain_texts
from crawlspark.operators.relevance import host_means, mean_similarity, pooled_similarity, ranked


def url_similarity(content: DataFrame, kb: DataFrame, num_features: int | None = None) -> DataFrame:
    """`url`, `score`: mean similarity of each text URL to the knowledge base."""
    return mean_similarity(one_text_per_url(plain_texts(content)), kb, num_features=num_features)


def host_similarity(content: DataFrame, kb: DataFrame, num_features: int | None = None) -> DataFrame:
    """`host`, `score`: hosts by mean similarity of their URLs, best first."""
    return ranked(host_means(url_similarity(content, kb, num_features)), "host")


def top_domains(content: DataFrame, kb: DataFrame) -> DataFrame:
    """`host`, `url`, `score`: similarity of each text URL to the pooled knowledge base."""
    scores = pooled_similarity(one_text_per_url(plain_texts(content)), kb)
    return scores.select(host(F.col("url")).alias("host"), "url", "score")
