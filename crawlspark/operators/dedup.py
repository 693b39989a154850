"""Content deduplication and merging of re-crawled pages."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.functions.identity import plain_path, sha_hex
from crawlspark.operators.joins import settled, skew_safe_join


def _content_hash(column: str) -> Column:
    """Hash of a column; a null has the empty text for a hash, so that it matches other nulls."""
    return F.coalesce(sha_hex(F.col(column)), F.lit(""))


# Text of up to so many bytes is grouped as it is, as it takes less room in a shuffle than its hash.
SHORT_BYTES = 64
_DIGITS = "^[0-9A-F]{64}$"


def _document_key(path: Column, doc_id: Column, *hashes: str) -> Column:
    """128 bits of a hash of path, id and content keys. The length of the path says where the id begins."""
    path = plain_path(path)
    return F.substring(F.unhex(F.sha2(F.concat_ws("\n", *hashes, F.length(path).cast("string"), path, doc_id), 256)), 1, 16)


def _packed(name: str) -> tuple[Column, Column]:
    """A text column as two, of which one is null: the 64 digits of a hash as 32 bytes, or any other text."""
    is_hash = F.coalesce(F.col(name).rlike(_DIGITS) & (F.length(name) == 64), F.lit(False))
    return F.when(is_hash, F.unhex(name)).alias(f"{name}_bytes"), F.when(~is_hash, F.col(name)).alias(f"{name}_text")


def _unpacked(name: str) -> Column:
    return F.coalesce(F.hex(f"{name}_bytes"), f"{name}_text").alias(name)


def dedup_index(dump: DataFrame) -> DataFrame:
    """Index of the documents to keep: one `(path, doc_id)` per distinct (url, content).

    `dump` holds dumped documents with the `path` they were read from. The
    smallest path, then id, survives. Only short URLs and hashes are grouped, as bytes and with partial
    aggregation, so a group of copies of any size costs one row per task.
    """
    is_short = F.coalesce(F.octet_length("url") <= SHORT_BYTES, F.lit(False))
    keyed = dump.select(
        F.when(is_short, F.col("url")).alias("short_url"), F.when(~is_short, F.unhex(_content_hash("url"))).alias("long_url"),
        F.unhex(_content_hash("raw_content")).alias("content_hash"), plain_path(F.col("path")).alias("path"), *_packed("_id"))
    # The smallest of the ids that are hashes and of the others; the smaller of both is the smallest id.
    is_hash = F.col("_id_bytes").isNotNull()
    grouped = keyed.groupBy("short_url", "long_url", "content_hash").agg(
        F.min(F.when(is_hash, F.struct("path", "_id_bytes"))).alias("hashed"),
        F.min(F.when(~is_hash, F.struct("path", F.col("_id_text").alias("doc_id")))).alias("other"))
    hashed = F.when(F.col("hashed").isNotNull(), F.struct("hashed.path", F.hex("hashed._id_bytes").alias("doc_id")))
    return grouped.withColumn("kept", F.least(hashed, "other")).select(
        "kept.path", "kept.doc_id", F.coalesce(sha_hex(F.col("short_url")), F.hex("long_url")).alias("url_hash"),
        F.hex("content_hash").alias("content_hash"))


def settled_index(index: DataFrame) -> DataFrame:
    """An index that `dedup_index` made, written once where the cluster allows it (see `settled`), its hashes as bytes."""
    hashes = ("url_hash", "content_hash")
    stored = settled(index.select("path", *_packed("doc_id"), *[F.unhex(name).alias(name) for name in hashes]))
    return stored.select("path", _unpacked("doc_id"), *[F.hex(name).alias(name) for name in hashes])


def apply_dedup_index(dump: DataFrame, index: DataFrame, exact: bool = False) -> DataFrame:
    """Documents of `dump` listed in the index.

    Documents match on path and id, so equal lines within one file all survive;
    `exact` also compares the content keys, null with null, and keeps one of such lines.
    """
    columns = dump.columns
    named = dump.where("path is not null and _id is not null")
    if not exact:
        kept = index.dropna(subset=["path", "doc_id"]).select(
            _document_key(F.col("path"), F.col("doc_id")).alias("__key")).distinct()
        keyed = named.withColumn("__key", _document_key(F.col("path"), F.col("_id")))
        return skew_safe_join(keyed, kept, ["__key"], "left_semi").select(*columns)
    hashes = ("url_hash", "content_hash")
    kept = index.dropna(subset=["path", "doc_id", *hashes]).select(
        _document_key(F.col("path"), F.col("doc_id"), *hashes).alias("key")).distinct()
    line = F.struct(*[name for name in columns if name != "_id"], *_packed("_id"))
    keyed = named.select(
        line.alias("line"), F.xxhash64(F.to_json(F.struct(*columns))).alias("row_hash"),
        "path", "_id", _content_hash("url").alias("url_hash"), _content_hash("raw_content").alias("content_hash"))
    # Lines with equal keys may differ in other fields: that of the smallest row hash stays. Bodies move once, by one
    # short key, and each task passes on one line per key, so neither copies nor a second join move any again.
    first = keyed.select(_document_key(F.col("path"), F.col("_id"), *hashes).alias("key"), "row_hash", "line").groupBy("key").agg(
        F.min_by("line", "row_hash").alias("line"))
    # Both sides lie by key with one row each, so nothing is skewed and nothing moves for the join.
    found = first.join(kept, "key", "left_semi").select("line.*")
    return found.select(*[_unpacked(name) if name == "_id" else name for name in columns])


def merge_segments(content: DataFrame, time: Column) -> DataFrame:
    """The newest record of every URL; equal times fall back to segment and content order.

    The newest is found on narrow columns, so bodies move once, to meet what was found. Only
    rows that agree in all of these are compared as rows: there every task passes on one row per URL,
    so that no task meets all copies of a page.
    """
    columns = content.columns
    ties = [F.col(name) for name in ("segment", "content_type", "http_date") if name in columns]
    # A struct is never null, so that rows without URL meet too.
    marked = content.withColumns({
        "__url": F.struct("url"),
        "__order": F.struct(time.alias("time"), *ties, F.sha2(F.col("content"), 256).alias("body"))})
    counted = marked.groupBy("__url", "__order").agg(F.count("*").alias("n"))
    newest = counted.groupBy("__url").agg(F.max(F.struct("__order", "n")).alias("newest")).select(
        "__url", "newest.__order", "newest.n")
    # An inner join: a semi join would be pushed into each part of a union and read the found rows once per part.
    found = skew_safe_join(marked, newest, ["__url", "__order"])
    place = F.row_number().over(Window.partitionBy("__url").orderBy("__order"))
    first = found.where("n > 1").withColumn("__place", place).where("__place = 1")
    return found.where("n = 1").select(*columns).union(first.select(*columns))


def one_text_per_url(texts: DataFrame) -> DataFrame:
    """One `text` per `url`: that of the first segment, then the smallest text hash."""
    order = [F.col("segment")] if "segment" in texts.columns else []
    return texts.groupBy("url").agg(
        F.min_by("text", F.struct(*order, F.sha2("text", 256).alias("body"))).alias("text"))
