"""Tasks from input paths to output paths. Each refuses an output path that exists."""

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from crawlspark.operators.dedup import dedup_index
from crawlspark.operators.open_records import document_view, keep_indexed, relink_documents
from crawlspark.operators.records import RunLabels, image_ids, image_paths, latest_times
from crawlspark.operators.rejected import drop_rejected_documents, rejected_index
from crawlspark.operators.relevance import page_relevance, ranked
from crawlspark.operators.stats import crawl_totals, host_counts, ordered_hosts
from crawlspark.plans import dumps, relevance
from crawlspark.sources import catalogue, manifest, readers, writers


def dump_linked(spark: SparkSession, *, link_db: str, output_dir: str, labels: RunLabels, max_inlinks: int,
                segment_dir: str | None = None, segment_file: str | None = None, how: str = "inner",
                expanded: bool = False) -> None:
    content = readers.read_content(spark, segment_dir, segment_file)
    links = readers.read_links(spark, link_db)
    writers.write_json(dumps.linked_dump(content, links, labels, how, expanded, max_inlinks=max_inlinks), output_dir)


def dump_unlinked(spark: SparkSession, *, link_db: str, output_dir: str, labels: RunLabels,
                  segment_dir: str | None = None, segment_file: str | None = None) -> None:
    content = readers.read_content(spark, segment_dir, segment_file)
    links = readers.read_links(spark, link_db)
    writers.write_json(dumps.unlinked_dump(content, links, labels), output_dir)


def dump_index(spark: SparkSession, *, link_db: str, crawl_db: str, crawl_id: str, output_dir: str,
               max_inlinks: int, crawler: str = "", segment_dir: str | None = None, segment_file: str | None = None) -> None:
    content = readers.read_content(spark, segment_dir, segment_file)
    state = readers.read_state(spark, crawl_db)
    links = readers.read_links(spark, link_db)
    writers.write_index(dumps.index_dump(content, state, links, crawl_id, crawler, max_inlinks=max_inlinks), output_dir)


def build_dedup_index(spark: SparkSession, *, output_dir: str, dump_dir: str | None = None,
                      dump_file: str | None = None) -> None:
    writers.write_table(dedup_index(readers.read_dump(spark, dump_dir, dump_file)), output_dir)


def deduplicate(spark: SparkSession, *, hash_dir: str, output_dir: str, dump_dir: str | None = None,
                dump_file: str | None = None, exact: bool = False) -> None:
    """The documents the index keeps, with all their fields."""
    documents = readers.read_open_dump(spark, dump_dir, dump_file)
    index = readers.read_dedup_index(spark, hash_dir)
    writers.write_document_parts(keep_indexed(documents, index, exact), output_dir)


def build_rejected_index(spark: SparkSession, *, hash_dir: str, output_dir: str, dump_dir: str | None = None,
                         dump_file: str | None = None) -> None:
    """`path`, `_id` of the documents that the dedup index below `hash_dir` does not keep."""
    documents = document_view(readers.read_open_dump(spark, dump_dir, dump_file), "_id")
    writers.write_table(rejected_index(documents, readers.read_dedup_index(spark, hash_dir)), output_dir)


def deduplicate_rejected(spark: SparkSession, *, rejected_dir: str, output_dir: str, dump_dir: str | None = None,
                         dump_file: str | None = None) -> None:
    """The documents that `deduplicate` keeps, filtered where they lie by the index of the rejected."""
    documents = readers.read_open_dump(spark, dump_dir, dump_file)
    rejected = spark.read.schema("path string, _id string").parquet(rejected_dir)
    writers.write_document_parts(drop_rejected_documents(documents, rejected), output_dir)


def relink_dumped_images(spark: SparkSession, *, segment_dir: str, dump_dir: str, output_dir: str) -> None:
    """Image documents with ids for parent and inlinks, and all their other fields."""
    times = latest_times(readers.read_content(spark, segment_dir))
    writers.write_document_parts(relink_documents(readers.read_open_dump(spark, dump_dir), times), output_dir)


def export_images(spark: SparkSession, *, output_dir: str, by: str = "id", segment_dir: str | None = None,
                  segment_file: str | None = None) -> None:
    """Image files named by document id (`by="id"`) or by site path (`by="path"`)."""
    content = readers.read_content(spark, segment_dir, segment_file)
    images = {"id": image_ids, "path": image_paths}[by](content)
    writers.export_images(images, output_dir)


def export_images_with_manifest(spark: SparkSession, *, output_dir: str, by: str = "id", catalogue_dir: str,
                                segments: Sequence[str] | None = None) -> int:
    """Images of a catalogue, or of some of its segments, with the manifest of what was exported; opens no other content."""
    content = catalogue.read_catalogue(spark, catalogue_dir, segments, kinds=("image",))
    return manifest.export_with_manifest({"id": image_ids, "path": image_paths}[by](content), output_dir)


def build_catalogue(spark: SparkSession, *, output_dir: str, segment_dir: str | None = None,
                    segment_file: str | None = None) -> None:
    """Segments as `segment=<name>/kind=<kind>` folders; `catalogue.write_segment` adds later ones."""
    catalogue.write_catalogue(readers.read_content(spark, segment_dir, segment_file), output_dir)


def crawl_statistics(spark: SparkSession, *, output_dir: str, segment_dir: str | None = None,
                     segment_file: str | None = None) -> None:
    """Writes `all_segments`, `host_urls` (counts, largest first) and `totals` below the output folder.

    Counts are written once and the totals read from them, so the pages are scanned once per output.
    """
    content = readers.read_content(spark, segment_dir, segment_file)
    writers.write_table(content, f"{output_dir}/all_segments")
    writers.write_table(ordered_hosts(host_counts(content)), f"{output_dir}/host_urls")
    counts = spark.read.parquet(f"{output_dir}/host_urls")
    writers.write_table(crawl_totals(counts), f"{output_dir}/totals")


def rank_pages(spark: SparkSession, *, knowledge_base: str, output_dir: str, stop_words: str | None = None,
               segment_dir: str | None = None, segment_file: str | None = None) -> None:
    """(host, url, score) of every text page. Give the stop-word file to score with your own list."""
    content = readers.read_content(spark, segment_dir, segment_file)
    kb = readers.read_knowledge_base(spark, knowledge_base)
    words = readers.read_stop_words(spark, stop_words)
    writers.write_csv(page_relevance(content, kb, words), output_dir)


def rank_hosts(spark: SparkSession, *, knowledge_base: str, output_dir: str, segment_dir: str | None = None,
               segment_file: str | None = None) -> None:
    content = readers.read_content(spark, segment_dir, segment_file)
    kb = readers.read_knowledge_base(spark, knowledge_base)
    writers.write_host_report(relevance.host_similarity(content, kb), output_dir)


def rank_top_domains(spark: SparkSession, *, knowledge_base: str, output_dir: str,
                     segment_dir: str | None = None, segment_file: str | None = None) -> None:
    content = readers.read_content(spark, segment_dir, segment_file)
    kb = readers.read_knowledge_base(spark, knowledge_base)
    scores = ranked(relevance.top_domains(content, kb), "url")
    writers.write_csv(scores.select("host", "url", F.col("score")), output_dir)
