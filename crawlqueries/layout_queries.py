"""Queries over the catalogue, the index of the rejected and the image manifest, with their SQL twins."""

from pyspark.sql import functions as F

from crawlqueries import views as V
from crawlqueries.file_queries import new_folder
from crawlqueries.oracle import BASE, DUMP, RE_BASE, site_path, with_tables
from crawlqueries.oracle import ORACLE_SQL as SQL
from crawlspark.operators import dedup, records, rejected
from crawlspark.operators.joins import settled
from crawlspark.sources import catalogue, manifest, writers


def _catalogue(spark, sf) -> str:
    """The crawl as a catalogue; the second fetch of the web pages is added as a segment of its own."""
    root, pages = new_folder(spark), V.recrawled_content(spark, sf)
    catalogue.write_catalogue(pages.where("segment <> 'web2'"), root)
    catalogue.write_segment(pages.where("segment = 'web2'"), root, "web2")
    return root


def catalogue_scan(spark, sf):
    found = catalogue.read_catalogue(spark, _catalogue(spark, sf), segments=("web2", "shop"), kinds=("text", "other"))
    return found.select("segment", "kind", "url", "content_type", F.sha2("content", 256).alias("sha256"), "http_date")


def catalogue_sizes(spark, sf):
    sizes = catalogue.catalogue_sizes(catalogue.read_catalogue(spark, _catalogue(spark, sf)))
    return sizes.select("segment", "kind", "n_rows", (F.col("n_files") > 0).alias("has_files"),
                        (F.col("n_bytes") > 0).alias("has_bytes"))


def dump_parts_pruned(spark, sf):
    root = new_folder(spark)
    writers.write_parts(V.dump(spark, sf), root)
    return catalogue.read_dump_parts(spark, root, ("part-00000", "part-00003")).select(
        "part", "_id", "url", "raw_content", "timestamp")


def _rejected(dump):
    return settled(rejected.rejected_index(dump, dedup.settled_index(dedup.dedup_index(dump))))


def rejected_index(spark, sf):
    return _rejected(V.dump(spark, sf))


def dedup_apply_rejected(spark, sf):
    dump = V.dump(spark, sf)
    return rejected.drop_rejected(dump, _rejected(dump)).select("path", "_id", "url", "raw_content")


def image_manifest(spark, sf):
    folder = new_folder(spark)
    # Bytes that are no text, as images have them.
    body = F.unhex(F.concat(F.lit("89FF00"), F.hex("content")))
    manifest.export_with_manifest(records.image_paths(V.content(spark, sf)).withColumn("content", body), folder)
    return manifest.read_exported(spark, folder).select(
        "path", "n_bytes", "sha256", (F.sha2("content", 256) == F.col("sha256")).alias("is_whole"),
        F.hex(F.substring("content", 1, 8)).alias("opening"))


QUERIES = {query.__name__: query for query in (
    catalogue_scan, catalogue_sizes, dump_parts_pruned, rejected_index, dedup_apply_rejected, image_manifest)}

_KIND = "CASE WHEN is_image THEN 'image' WHEN is_text THEN 'text' ELSE 'other' END"
_BODY = "(from_hex('89FF00') || encode(content))"
ORACLE_SQL = {
    "catalogue_scan": with_tables(*RE_BASE) + f"""
SELECT segment, {_KIND} AS kind, url, content_type, sha256(content) AS sha256, http_date
FROM re_page WHERE segment IN ('web2', 'shop') AND NOT is_image""",
    "catalogue_sizes": with_tables(*RE_BASE) + f"""
SELECT segment, {_KIND} AS kind, count(*) AS n_rows, true AS has_files, true AS has_bytes FROM re_page GROUP BY ALL""",
    "dump_parts_pruned": SQL["dump_parts"] + " WHERE path IN ('/dump/part-00000', '/dump/part-00003')",
    "rejected_index": with_tables(*RE_BASE, DUMP) + """
SELECT DISTINCT path, _id FROM dump WHERE (path, _id) NOT IN (SELECT (kept[1], kept[2]) FROM dump_index)""",
    "dedup_apply_rejected": SQL["dedup_apply"],
    "image_manifest": with_tables(*BASE) + f"""
SELECT {site_path('url')} AS path, strlen(content)::BIGINT + 3 AS n_bytes, sha256({_BODY}) AS sha256, true AS is_whole,
  hex({_BODY})[1:16] AS opening FROM page WHERE is_image""",
}
