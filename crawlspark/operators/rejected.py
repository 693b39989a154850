"""Deduplication by the index of the rejected: which documents go, instead of which stay.

The rejected are usually the smaller list. While it is small enough to broadcast, documents are filtered where they
lie: no document is moved, whatever the size of the dump.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.identity import plain_path
from crawlspark.operators.joins import BROADCAST_BYTES, lookup_join, skew_safe_join
from crawlspark.operators.open_records import document_view

_KEYS = ["match_path", "_id"]


def rejected_index(dump: DataFrame, index: DataFrame) -> DataFrame:
    """`path`, `_id`, once each, of the documents of `dump` that a dedup index does not keep.

    Keys alone are compared. Documents without path or id match no entry of an index; they
    are not listed, as `drop_rejected` drops them without a list.
    """
    keys = dump.select(plain_path(F.col("path")).alias("match_path"), "_id").dropna().distinct()
    kept = index.select(plain_path(F.col("path")).alias("match_path"), F.col("doc_id").alias("_id")).distinct()
    return skew_safe_join(keys, kept, _KEYS, "left_anti").select(F.col("match_path").alias("path"), "_id")


def drop_rejected(dump: DataFrame, rejected: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Documents of `dump` that are not rejected: the rows that `apply_dedup_index` keeps with the index itself.

    Runs one aggregate job over `rejected`, so give a table that is written. Within `broadcast_bytes`
    documents stay where they are; beyond it they are shuffled by path and id.
    """
    keyed = dump.where("path is not null and _id is not null").withColumn("match_path", plain_path(F.col("path")))
    keys = rejected.select(plain_path(F.col("path")).alias("match_path"), "_id")
    return lookup_join(keyed, keys, _KEYS, "left_anti", broadcast_bytes).select(*dump.columns)


def drop_rejected_documents(documents: DataFrame, rejected: DataFrame) -> DataFrame:
    """Open documents (`path`, `doc`) that are not rejected, whole; see `drop_rejected`."""
    return drop_rejected(document_view(documents, "_id"), rejected).select(*documents.columns)
