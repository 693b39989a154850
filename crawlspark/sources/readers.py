"""Tables of a crawl. Every reader is one scan with a fixed schema."""

import os
from collections.abc import Iterator, Sequence
from importlib import resources

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.fixed_values import KB_DELIMITER
from crawlspark.operators.open_records import open_documents
from crawlspark.schemas import CRAWL_CONTENT, CRAWL_DB, CRAWL_LINKS, DEDUP_INDEX, DUMP_RECORD


def _scan(spark: SparkSession, paths: Sequence[str], schema: T.StructType, fmt: str,
          options: dict | None = None) -> DataFrame:
    if fmt not in ("parquet", "orc", "json"):
        raise ValueError(f"unknown table format: {fmt}")
    reader = spark.read.schema(schema).options(**(options or {}))
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(list(paths))


def read_path_list(spark: SparkSession, list_file: str) -> list[str]:
    """Paths named in a list file, one per line. A missing or empty list raises."""
    paths = [row.value.strip() for row in spark.read.text(list_file).collect() if row.value.strip()]
    if not paths:
        raise ValueError(f"no paths in {list_file}")
    return paths


def read_parts(spark: SparkSession, root: str, sub_dir: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """All `<root>/**/<sub_dir>/part-*` files below `root`, with the `segment` folder each comes from.

    The path condition is on file metadata, so other files are skipped before they are opened.
    """
    df = _scan(spark, [root], schema, fmt, {"recursiveFileLookup": "true"})
    path = F.col("_metadata.file_path")
    pattern = rf"([^/]*)/{sub_dir}/part-[^/]*(?:/[^/]*)?$"
    return df.where(path.rlike(pattern)).select("*", F.regexp_extract(path, pattern, 1).alias("segment"))


def read_content(spark: SparkSession, segment_dir: str | None = None, segment_file: str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Page content of all segments below a folder, or of the paths in a list file."""
    if segment_dir:
        return read_parts(spark, segment_dir, "content", CRAWL_CONTENT, fmt)
    if not segment_file:
        raise ValueError("a segment folder or a segment list file is needed")
    df = _scan(spark, read_path_list(spark, segment_file), CRAWL_CONTENT, fmt, {"recursiveFileLookup": "true"})
    segment = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)/content/", 1)
    return df.select("*", segment.alias("segment"))


def read_links(spark: SparkSession, link_db: str, fmt: str = "parquet") -> DataFrame:
    """Edge list of the link graph (`current` parts)."""
    return read_parts(spark, link_db, "current", CRAWL_LINKS, fmt).drop("segment")


def read_state(spark: SparkSession, crawl_db: str, fmt: str = "parquet") -> DataFrame:
    """Crawl state (`current` parts)."""
    return read_parts(spark, crawl_db, "current", CRAWL_DB, fmt).drop("segment")


def _dump_files(spark: SparkSession, dump_dir: str | None, dump_file: str | None) -> tuple[list[str], dict]:
    if not dump_dir and not dump_file:
        raise ValueError("a dump folder or a dump list file is needed")
    paths = [dump_dir] if dump_dir else read_path_list(spark, dump_file)
    return paths, {"recursiveFileLookup": "true"} | ({"pathGlobFilter": "part-*"} if dump_dir else {})


def read_dump(spark: SparkSession, dump_dir: str | None = None, dump_file: str | None = None) -> DataFrame:
    """The typed fields of dumped documents, one JSON object per line, with the `path` of their file. Bad lines raise.

    Other fields of the documents are not read; `read_open_dump` keeps them.
    """
    paths, options = _dump_files(spark, dump_dir, dump_file)
    df = _scan(spark, paths, DUMP_RECORD, "json", options)
    return df.select("*", F.col("_metadata.file_path").alias("path"))


def read_open_dump(spark: SparkSession, dump_dir: str | None = None, dump_file: str | None = None) -> DataFrame:
    """`path`, `doc`: dumped documents whole, as VARIANT. Bad lines raise."""
    paths, options = _dump_files(spark, dump_dir, dump_file)
    lines = spark.read.options(**options).text(paths)
    return open_documents(lines.select(F.col("_metadata.file_path").alias("path"), "value"))


def read_dedup_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEDUP_INDEX).parquet(path)


#: Bytes of file content that one Arrow batch of `read_files` holds, about.
BATCH_BYTES = 16 << 20


def read_files(names: DataFrame, folder: str, name: str) -> DataFrame:
    """`names` with the `content` of the file below `folder` that column `name` gives; null where there is no such file.

    Executors open the files by name. The driver lists nothing, so it holds as little for many files as for few.
    """
    place = folder.rstrip("/") if "://" in folder else os.path.abspath(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(place)
        if system.get_file_info(root).type != FileType.Directory:
            raise FileNotFoundError(f"{folder} is not shared with this executor")
        for batch in batches:
            contents, first, size = [], 0, 0
            for number, file in enumerate(batch.column(batch.schema.get_field_index(name)).to_pylist()):
                content = None
                if file:
                    try:
                        with system.open_input_stream(f"{root}/{file}") as stream:
                            content = stream.read()
                    except FileNotFoundError:
                        pass
                contents.append(content)
                size += len(content or b"")
                if size >= BATCH_BYTES or number == batch.num_rows - 1:
                    rows = batch.slice(first, number + 1 - first)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(contents, pa.binary())], [*rows.schema.names, "content"])
                    contents, first, size = [], number + 1, 0

    return names.mapInArrow(read, T.StructType([*names.schema.fields, T.StructField("content", T.BinaryType())]))


def dump_of_lines(lines: DataFrame) -> DataFrame:
    """The typed fields of dumped documents from a table of JSON lines in `value`; other columns stay. Bad lines raise.

    `open_documents` keeps all fields.
    """
    others = [name for name in lines.columns if name != "value"]
    record = F.from_json("value", DUMP_RECORD, {"mode": "FAILFAST"}).alias("record")
    return lines.select(*others, record).select(*others, "record.*")


def read_knowledge_base(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge-base lines `url|_|text` as `kb_url`, `kb_text`."""
    return knowledge_base_of_lines(spark.read.text(path))


def knowledge_base_of_lines(lines: DataFrame) -> DataFrame:
    """`kb_url`, `kb_text` of lines in `value`; a line of one field has an empty text, fields past the second are ignored."""
    fields = F.split(F.col("value"), rf"\Q{KB_DELIMITER}\E")
    return lines.select(
        F.get(fields, F.lit(0)).alias("kb_url"), F.coalesce(F.get(fields, F.lit(1)), F.lit("")).alias("kb_text"))


def default_stop_words() -> list[str]:
    """Words of the packaged English list."""
    text = resources.files("crawlspark").joinpath("stop_words_en.txt").read_text(encoding="utf-8")
    return [line.strip().lower() for line in text.splitlines() if line.strip()]


def read_stop_words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Distinct stop words in lower case, from a file with one word per line or the packaged list."""
    if path is None:
        return spark.createDataFrame([(word,) for word in default_stop_words()], "word string").distinct()
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).where(word != "").distinct()


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks are null."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
