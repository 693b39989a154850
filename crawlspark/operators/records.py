"""Flat documents and search-index records built from crawled content."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.fixed_values import DUMP_RECORD_VERSION, INDEX_RECORD_VERSION
from crawlspark.functions.filters import is_image, is_parsable, is_text_type, is_usable
from crawlspark.functions.identity import body_text, document_id, index_id, sha_hex
from crawlspark.functions.state import interval_days, last_modified_millis, status_code, status_name
from crawlspark.functions.text import decode_entities, extract_text, gated_text, metadata_map
from crawlspark.functions.times import http_date_millis, http_date_text, index_time
from crawlspark.functions.urls import host, stored_path
from crawlspark.operators.joins import settled, skew_safe_join
from crawlspark.operators.links import with_outlinks
from crawlspark.operators.metadata import all_fields, distinct_fields, field_maps


# Documents with one link list that meet it in one place.
DOCUMENTS_PER_LIST = 10_000


@dataclass(frozen=True)
class RunLabels:
    """Constants of one run that every document carries."""

    doc_type: str = ""
    crawler: str = ""
    team: str = ""
    version: str = DUMP_RECORD_VERSION


def _column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def dump_records(content: DataFrame, labels: RunLabels, expanded: bool = False,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Flat documents. Input: content columns, with `parent` and `inlinks` where links are known.

    The document time is `fetch_time` where that column exists and is set, else
    the HTTP date. Links go to image documents only; `expanded` gives them to
    every type and adds the host. Columns named in `carry` are passed through.
    """
    url, content_type = F.col("url"), F.col("content_type")
    body = body_text(F.col("content"))
    date = http_date_text(F.col("http_date"))
    if "fetch_time" in content.columns:
        date = F.coalesce(F.col("fetch_time").cast("string"), date)
    linked = F.lit(True) if expanded else is_image(content_type)
    parent = _column_or_null(content, "parent", "string")
    inlinks = _column_or_null(content, "inlinks", "array<string>")
    no_metadata = F.create_map().cast("map<string,array<string>>")
    columns = [
        document_id(url, date).alias("_id"),
        F.lit(labels.doc_type).alias("doc_type"),
        content_type,
        body.alias("raw_content"),
        gated_text(content_type, body).alias("extracted_text"),
        F.when(is_parsable(content_type), metadata_map(body, content_type)).otherwise(no_metadata).alias("extracted_metadata"),
        F.lit(labels.crawler).alias("crawler"),
        url.alias("obj_original_url"),
        stored_path(url).alias("obj_stored_url"),
        F.lit(labels.team).alias("team"),
        F.lit(labels.version).alias("version"),
        url,
        date.alias("timestamp"),
    ]
    if expanded:
        columns.append(host(url).alias("host"))
    columns += [
        F.when(linked, parent).alias("obj_parent"),
        F.when(linked & inlinks.isNotNull(), F.struct(inlinks.alias("inlinks"))).alias("crawl_data"),
    ]
    if "n_inlinks" in content.columns:
        columns.append(F.coalesce("n_inlinks", F.lit(0)).alias("n_inlinks"))
    return content.select(*columns, *carry)


def minimal_records(content: DataFrame, labels: RunLabels) -> DataFrame:
    """Short documents whose id is the URL itself."""
    return content.select(
        F.col("url").alias("_id"),
        "content_type",
        body_text(F.col("content")).alias("raw_content"),
        F.lit(labels.crawler).alias("crawler"),
        F.col("url").alias("obj_original_url"),
        F.lit(labels.team).alias("team"),
        F.lit(labels.version).alias("version"),
        http_date_text(F.col("http_date")).alias("timestamp"),
    )


def index_records(content: DataFrame, crawl_id: str, crawler: str, indexed_at: Column | None = None) -> DataFrame:
    """Search-index records. Input: content joined with crawl state, `parent` and `inlinks` where known.

    Text, outlinks and typed metadata are filled for text types only. Dynamic
    metadata fields sit in one map column per value type (`md_*`).
    """
    url, content_type = F.col("url"), F.col("content_type")
    body = body_text(F.col("content"))
    is_text = is_text_type(content_type)
    if indexed_at is None:
        indexed_at = F.unix_millis(F.current_timestamp())
    # Pages that are not text have no body to parse, so none of the patterns run on them.
    parsed = with_outlinks(content.withColumn("body", F.when(is_text, body)))
    prepared = parsed.withColumn("metadata_fields", all_fields(metadata_map(F.col("body"), content_type))).withColumn(
        "metadata_fields", distinct_fields(F.col("metadata_fields")))
    return prepared.select(
        index_id(url, F.lit(crawl_id), F.col("fetch_time")).alias("id"),
        content_type,
        F.lit(crawler).alias("crawler"),
        F.lit(crawl_id).alias("crawl_id"),
        url,
        index_time(F.col("fetch_time")).alias("fetch_timestamp"),
        F.col("body").alias("raw_content"),
        F.when(is_text, extract_text(F.col("body"), content_type=content_type)).alias("extracted_text"),
        F.when(is_text, F.col("outlinks")).alias("outlinks"),
        status_name(F.col("status")).alias("status_name"),
        status_code(F.col("metadata")).alias("status_code"),
        "score",
        host(url).alias("hostname"),
        host(url).alias("group"),
        index_time(last_modified_millis(F.col("metadata"))).alias("modified_time"),
        F.col("retries").alias("retries_since_fetch"),
        F.col("fetch_interval").alias("retry_interval_seconds"),
        interval_days(F.col("fetch_interval")).alias("retry_interval_days"),
        sha_hex(body).alias("signature"),
        F.lit(INDEX_RECORD_VERSION).alias("version"),
        _column_or_null(content, "parent", "string").alias("obj_parent"),
        _column_or_null(content, "inlinks", "array<string>").alias("inlinks"),
        F.coalesce(_column_or_null(content, "n_inlinks", "bigint"), F.lit(0)).cast("bigint").alias("n_inlinks"),
        stored_path(url).alias("obj_relative_path"),
        index_time(indexed_at).alias("indexed_at"),
        *[column.alias(name) for name, column in field_maps(F.when(is_text, F.col("metadata_fields"))).items()],
    )


def usable_urls(content: DataFrame) -> DataFrame:
    """URLs of the usable rows, one per row."""
    return content.where(is_usable(F.col("content_type"), F.col("content"))).select("url")


def plain_texts(content: DataFrame, decode: Callable[[Column], Column] = decode_entities) -> DataFrame:
    """`url` and `text` of every text page, with `segment` where the input has one."""
    extra = [name for name in ("segment",) if name in content.columns]
    text = gated_text(F.col("content_type"), body_text(F.col("content")), decode)
    return content.where(is_text_type(F.col("content_type"))).select("url", *extra, text.alias("text"))


def latest_times(content: DataFrame) -> DataFrame:
    """`url` and `timestamp`: the newest HTTP date of each URL as text, null where none parses."""
    return content.select("url", http_date_millis(F.col("http_date")).alias("millis")).groupBy("url").agg(
        F.max("millis").cast("string").alias("timestamp"))


def relink_images(dump: DataFrame, times: DataFrame) -> DataFrame:
    """Image documents with parent and inlink URLs replaced by the ids of those documents.

    `times` holds one `timestamp` per `url`. A URL missing there hashes with the
    text `null`; a document without a parent or links keeps it so. Each distinct
    link list is looked up once, edge by edge, so copies and widely linking
    pages do not multiply work.
    """
    # Their lists and the documents themselves are both needed below: made once, where a shared folder is set.
    images = settled(dump.where(is_image(F.col("content_type"))))
    columns = dump.columns
    links = F.struct(F.col("obj_parent").alias("parent"), F.col("crawl_data.inlinks").alias("inlinks"))
    # 128 bits of the hash, as bytes, tell lists apart; lists themselves go where they are looked up only.
    keyed = images.withColumn("link_key", F.substring(F.unhex(F.sha2(F.to_json(links), 256)), 1, 16))
    wanted = keyed.select("link_key", "obj_parent", F.col("crawl_data.inlinks").alias("inlinks")).dropDuplicates(
        ["link_key"])
    # A null url marks the parent's own row or a list without members; it joins to nothing.
    edges = wanted.select(
        "link_key",
        F.inline(F.concat(
            F.array(F.struct(F.col("obj_parent").alias("url"), F.lit(True).alias("is_parent"))),
            F.transform(F.coalesce("inlinks", F.array().cast("array<string>")),
                        lambda link: F.struct(link.alias("url"), F.lit(False).alias("is_parent"))))))
    # Lists of many documents meet those in several places. They are few, however many documents, so they are broadcast.
    common = F.broadcast(keyed.groupBy("link_key").agg(F.count("*").alias("n")).where(F.col("n") > DOCUMENTS_PER_LIST).select(
        "link_key", F.ceil(F.col("n") / DOCUMENTS_PER_LIST).alias("places")))
    looked_up = skew_safe_join(edges, times, ["url"], "left").join(common, "link_key", "left").withColumn(
        "place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("places", F.lit(1)) - 1)))
    # Ids are made where a list's edges have met again, and stay bytes, half as long as their digits, which sort alike.
    named = looked_up.repartition("link_key", "place").withColumn(
        "target", F.when(F.col("url").isNotNull(), F.unhex(document_id(F.col("url"), F.col("timestamp")))))
    renamed = named.groupBy("link_key", "place").agg(
        F.max(F.when(F.col("is_parent"), F.col("target"))).alias("new_parent"),
        F.array_sort(F.collect_set(F.when(~F.col("is_parent"), F.col("target")))).alias("new_inlinks"))
    bare = keyed.withColumn("has_links", F.col("crawl_data").isNotNull()).drop("obj_parent", "crawl_data")
    placed = bare.join(common, "link_key", "left").withColumn(
        "place", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("places")), F.lit(0).cast("bigint")))
    # New lists stay where they were made: no place has more documents than one task takes.
    joined = placed.join(renamed, ["link_key", "place"], "left")
    replaced = joined.withColumns({
        "obj_parent": F.hex("new_parent"),
        "crawl_data": F.when(F.col("has_links"), F.struct(
            F.transform("new_inlinks", lambda link: F.hex(link)).alias("inlinks"))),
    })
    return replaced.select(*columns)


def image_ids(content: DataFrame) -> DataFrame:
    """`path`, `content` of every image, named by document id."""
    name = document_id(F.col("url"), http_date_text(F.col("http_date")))
    return content.where(is_image(F.col("content_type"))).select("url", name.alias("path"), "content")


def image_paths(content: DataFrame) -> DataFrame:
    """`path`, `content` of every image, named by site path."""
    return content.where(is_image(F.col("content_type"))).select(
        "url", stored_path(F.col("url")).alias("path"), "content")
