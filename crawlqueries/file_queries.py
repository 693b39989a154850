"""Queries that go through files: what a sink writes is read back by its source and shown."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlqueries import views as V
from crawlspark.fixed_values import MAX_INLINKS
from crawlspark.functions.identity import body_text
from crawlspark.operators import dedup, open_records, ranking, records, relevance
from crawlspark.plans import dumps
from crawlspark.plans import relevance as relevance_plans
from crawlspark.schemas import CRAWL_CONTENT
from crawlspark.sources import readers, writers

SEGMENTS = ("web", "files", "shop", "web2")


def new_folder(spark: SparkSession) -> str:
    """A path below the folder all executors share; only local sessions without one get a folder of the machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="crawlqueries-")
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def _binary(content: DataFrame) -> DataFrame:
    return content.withColumn("content", F.col("content").cast("binary"))


def _segments(spark: SparkSession, sf: str) -> str:
    """The crawl as segments on disk, each with another table beside its content."""
    root = new_folder(spark)
    pages = _binary(V.recrawled_content(spark, sf))
    for segment in SEGMENTS:
        own = pages.where(F.col("segment") == segment)
        writers.write_table(own.select(*CRAWL_CONTENT.fieldNames()), f"{root}/{segment}/content")
        writers.write_table(own.select("url").limit(1), f"{root}/{segment}/parse_text")
    return root


def _shown(content: DataFrame) -> DataFrame:
    return content.select("segment", "url", "content_type", F.hex(F.substring("content", 1, 40)).alias("opening"),
                          F.sha2("content", 256).alias("sha256"), "http_date")


def segment_scan(spark, sf):
    return _shown(readers.read_content(spark, _segments(spark, sf)))


def path_list_scan(spark, sf):
    root, listing = _segments(spark, sf), new_folder(spark)
    paths = spark.createDataFrame([(f"{root}/{segment}/content",) for segment in ("web", "shop")], "value string")
    paths.write.text(listing)
    return _shown(readers.read_content(spark, segment_file=listing))


def link_scan(spark, sf):
    root = new_folder(spark)
    writers.write_table(V.links(spark, sf), f"{root}/current")
    return readers.read_links(spark, root).groupBy("to_url").agg(
        F.count("*").alias("n_links"), F.min("from_url").alias("first_link"))


def state_scan(spark, sf):
    root = new_folder(spark)
    writers.write_table(V.state(spark, sf), f"{root}/current")
    return readers.read_state(spark, root).select(
        "url", "status", "fetch_time", F.round("score", 8).alias("score"), "fetch_interval", "retries",
        F.size("metadata").alias("n_metadata"))


def segment_consolidation(spark, sf):
    path = new_folder(spark)
    writers.write_table(V.recrawled_content(spark, sf), path)
    return spark.read.parquet(path).groupBy("segment").agg(
        F.count("*").alias("n_rows"), F.sum(F.octet_length("content")).alias("n_bytes"))


def dump_parts(spark, sf):
    root = new_folder(spark)
    writers.write_parts(V.dump(spark, sf), root)
    dump = readers.read_dump(spark, root)
    return dump.select(F.regexp_extract("path", "/part=([^/]*)/[^/]*$", 1).alias("part"), "_id", "url", "raw_content", "timestamp")


def dedup_index_scan(spark, sf):
    path = new_folder(spark)
    writers.write_table(dedup.dedup_index(V.dump(spark, sf)), path)
    return readers.read_dedup_index(spark, path)


def index_lines(spark, sf):
    path = new_folder(spark)
    index = dumps.index_dump(V.content(spark, sf), V.state(spark, sf), V.links(spark, sf), V.CRAWL_ID, V.LABELS.crawler,
                             max_inlinks=MAX_INLINKS)
    writers.write_index(index, path)
    documents = open_records.open_documents(spark.read.text(path))
    field = lambda name, kind="string": open_records.document_field(F.col("doc"), name, kind).alias(name)
    return documents.select(field("id"), field("url"), field("signature"), field("n_inlinks", "bigint"), field("title_t_md"))


def page_score_lines(spark, sf):
    path = new_folder(spark)
    scores = relevance.page_relevance(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf), readers.read_stop_words(spark))
    writers.write_csv(scores, path)
    return spark.read.schema("host string, url string, score double").csv(path).select("host", "url", F.round("score", 8).alias("score"))


def host_report(spark, sf):
    path = new_folder(spark)
    writers.write_host_report(relevance_plans.host_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf)), path)
    parts = F.split("value", " - ")
    return spark.read.text(path).select(F.get(parts, F.lit(0)).alias("host"), F.round(F.get(parts, F.lit(1)).cast("double"), 8).alias("score"))


def host_ranks(spark, sf):
    scores = relevance_plans.host_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return ranking.with_ranks(scores, "host").select("host", F.round("score", 8).alias("score"), "rank")


def url_ranks(spark, sf):
    scores = relevance_plans.url_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return ranking.with_ranks(scores, "url").select("url", F.round("score", 8).alias("score"), "rank")


def image_files(spark, sf):
    path = new_folder(spark)
    images = _binary(records.image_paths(V.content(spark, sf))).select("path", "content")
    writers.export_images(images, path)
    files = readers.read_files(writers.exported_files(images), path, "file").where("content is not null")
    return files.select("path", F.octet_length("content").cast("bigint").alias("n_bytes"), body_text(F.col("content")).alias("text"))


QUERIES = {query.__name__: query for query in (
    segment_scan, path_list_scan, link_scan, state_scan, segment_consolidation, dump_parts, dedup_index_scan, index_lines,
    page_score_lines, host_report, host_ranks, url_ranks, image_files)}
