"""Page content as a catalogue: folders `segment=<name>/kind=<image, text or other>`.

The plain layout (`readers.read_parts`) finds segments by a pattern over all paths below a folder. Here the folders name
them, so a reader lists only the segments it asks for and opens only the kinds it needs: image jobs open no text
pages, text jobs no images. Dumps are laid out alike by input part (`part=<name>`, see `writers.write_parts`).
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions.filters import is_image, is_text_type
from crawlspark.schemas import CRAWL_CONTENT, DUMP_RECORD

KINDS = ("image", "text", "other")
CATALOGUE = T.StructType([*CRAWL_CONTENT.fields, T.StructField("segment", T.StringType()),
                          T.StructField("kind", T.StringType())])
DUMP_PARTS = T.StructType([*DUMP_RECORD.fields, T.StructField("part", T.StringType())])

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def content_kind(content_type: Column) -> Column:
    """`image` and `text` are exactly the types that `is_image` and `is_text_type` accept; all else, null included, is `other`."""
    return F.when(is_image(content_type), "image").when(is_text_type(content_type), "text").otherwise("other")


def _folder(root: str, column: str, name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a name of a {column}: {name!r}")
    return f"{root.rstrip('/')}/{column}={name}"


def _rows(content: DataFrame, *extra: str) -> DataFrame:
    body = F.col("content").cast("binary").alias("content")
    return content.select(*[body if name == "content" else name for name in CRAWL_CONTENT.fieldNames()], *extra,
                          content_kind(F.col("content_type")).alias("kind"))


def write_catalogue(content: DataFrame, root: str) -> None:
    """All segments of `content` (with a `segment` column) in one job. Bodies are not moved: every task writes its own files."""
    _rows(content, "segment").write.mode("errorifexists").partitionBy("segment", "kind").parquet(root)


def write_segment(content: DataFrame, root: str, segment: str) -> None:
    """Adds one segment to a catalogue. A segment that is there is refused, others are left alone."""
    _rows(content).write.mode("errorifexists").partitionBy("kind").parquet(_folder(root, "segment", segment))


def _paths(root: str, column: str, names: Sequence[str] | None) -> list[str]:
    if names is None:
        return [root]
    if not names:
        raise ValueError(f"no {column} is named")
    return [_folder(root, column, name) for name in dict.fromkeys(names)]


def read_catalogue(spark: SparkSession, root: str, segments: Sequence[str] | None = None,
                   kinds: Sequence[str] | None = None) -> DataFrame:
    """Page content with `segment` and `kind`: of all or of the named segments, of all or of some kinds.

    Folders of other segments are not even listed; a named segment that is missing raises.
    Files of other kinds are not opened.
    """
    if kinds is not None and not set(kinds) <= set(KINDS):
        raise ValueError(f"unknown kinds: {sorted(set(kinds) - set(KINDS))}")
    root = root.rstrip("/")
    content = spark.read.schema(CATALOGUE).option("basePath", root).parquet(*_paths(root, "segment", segments))
    return content if kinds is None else content.where(F.col("kind").isin(*kinds))


def catalogue_sizes(catalogue: DataFrame) -> DataFrame:
    """`segment`, `kind`, `n_rows`, `n_files`, `n_bytes` of a catalogue that was read. Opens file footers only."""
    files = catalogue.select("segment", "kind", F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_size").alias("size"))
    per_file = files.groupBy("segment", "kind", "file").agg(F.count("*").alias("rows"), F.max("size").alias("size"))
    return per_file.groupBy("segment", "kind").agg(
        F.sum("rows").alias("n_rows"), F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"))


def read_dump_parts(spark: SparkSession, root: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The typed fields of documents that `writers.write_parts` wrote, with `part` and `path`; of all or of the named parts."""
    root = root.rstrip("/")
    reader = spark.read.schema(DUMP_PARTS).option("basePath", root).option("mode", "FAILFAST")
    return reader.json(_paths(root, "part", parts)).select("*", F.col("_metadata.file_path").alias("path"))
