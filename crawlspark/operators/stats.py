"""Crawl statistics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.filters import is_usable
from crawlspark.functions.urls import host


def distinct_urls(content: DataFrame) -> DataFrame:
    """Distinct URLs of the usable rows."""
    return content.where(is_usable(F.col("content_type"), F.col("content"))).select("url").distinct()


def preview(rows: DataFrame, *order: str, n: int = 20) -> DataFrame:
    """The first `n` rows in the order given, by all columns where none is: each task passes on `n` rows at most."""
    return rows.orderBy(*(order or rows.columns)).limit(n)


def host_counts(content: DataFrame) -> DataFrame:
    """`host`, `n_urls`: distinct URLs per host. URLs without a host count under the empty name."""
    return distinct_urls(content).groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("n_urls"))


def ordered_hosts(counts: DataFrame) -> DataFrame:
    """Hosts by URL count, largest first; equal counts by name."""
    return counts.orderBy(F.desc("n_urls"), "host")


def distinct_hosts(content: DataFrame) -> DataFrame:
    return content.where(is_usable(F.col("content_type"), F.col("content"))).select(
        host(F.col("url")).alias("host")).distinct()


def crawl_totals(counts: DataFrame) -> DataFrame:
    """`n_hosts`, `n_pages` out of `host_counts`, so that one pass over the pages serves both."""
    return counts.agg(F.count("*").alias("n_hosts"), F.coalesce(F.sum("n_urls"), F.lit(0)).alias("n_pages"))
