"""Image export with a manifest: what was exported is what one committed table says.

Every task attempt writes below a folder of its own, `files/<attempt>/`, and returns one row per file. Spark's commit of these
rows accepts one attempt of each task, so attempts that failed, or ran twice, are in no row. From them the manifest
(`path`, `file`, `n_bytes`, `sha256`) is published with one more commit: until then a reader finds nothing, after it
everything. Files have numbers for names, so paths may be as long and as odd as they come.
"""

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.operators.joins import skew_safe_join
from crawlspark.sources import readers

FILES_PER_FOLDER = 1000
MANIFEST = "path string, file string, n_bytes bigint, sha256 string"


def _place(folder: str) -> str:
    return folder.rstrip("/") if "://" in folder else os.path.abspath(folder)


def export_with_manifest(images: DataFrame, folder: str) -> int:
    """Writes the images (`path`, `content`) that have both and publishes their manifest; returns how many there are.

    `folder` is a local path or a URI that both Spark and `pyarrow.fs` open; one that exists is refused, and one
    that an executor does not share fails. Every path is listed once: of several contents that with the smallest hash.
    Files that the manifest does not name are deleted at the end.
    """
    spark, place = images.sparkSession, _place(folder)
    system, root = FileSystem.from_uri(place)
    if system.get_file_info(root).type != FileType.NotFound:
        raise FileExistsError(folder)
    system.create_dir(f"{root}/files")

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(place)
        if system.get_file_info(f"{root}/files").type != FileType.Directory:
            raise FileNotFoundError(f"{folder} is not shared with this executor")
        attempt = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        written = 0
        for batch in batches:
            rows = {"path": batch.column("path"), "file": [], "n_bytes": [], "sha256": []}
            for content in batch.column("content"):
                below, number = divmod(written, FILES_PER_FOLDER)
                if number == 0:
                    system.create_dir(f"{root}/files/{attempt}/{below:06d}")
                file, body = f"{attempt}/{below:06d}/{number:04d}", content.as_buffer()
                with system.open_output_stream(f"{root}/files/{file}") as out:
                    out.write(body)
                rows["file"].append(file)
                rows["n_bytes"].append(body.size)
                rows["sha256"].append(hashlib.sha256(body).hexdigest())
                written += 1
            yield pa.RecordBatch.from_pydict(rows, pa.schema([
                ("path", batch.schema.field("path").type), ("file", pa.string()), ("n_bytes", pa.int64()),
                ("sha256", pa.string())]))

    whole = images.where("path <> '' and content is not null").select("path", F.col("content").cast("binary").alias("content"))
    whole.mapInArrow(write_files, MANIFEST).write.parquet(f"{place}/entries")
    entries = spark.read.schema(MANIFEST).parquet(f"{place}/entries")
    # Hashes and names alone are compared, with partial aggregation.
    least = entries.groupBy("path").agg(F.min(F.struct("sha256", "file", "n_bytes")).alias("least"))
    least.select("path", "least.file", "least.n_bytes", "least.sha256").write.parquet(f"{place}/manifest")
    _delete_unlisted(spark, place)
    return read_manifest(spark, folder).count()


def _delete_unlisted(spark: SparkSession, place: str) -> None:
    """Deletes files that lost their path to another, from the executors, and folders of attempts that were not accepted.

    The driver sees names of attempts only, about one per task.
    """
    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(place)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                # A task that is run again finds some of its files gone.
                if system.get_file_info(f"{root}/files/{file}").type == FileType.File:
                    system.delete_file(f"{root}/files/{file}")
            yield batch

    entries = spark.read.schema(MANIFEST).parquet(f"{place}/entries")
    listed = read_manifest(spark, place).select("file")
    spare = skew_safe_join(entries.select("file"), listed, ["file"], "left_anti")
    spare.mapInArrow(delete, "file string").write.format("noop").mode("overwrite").save()
    accepted = {row.attempt for row in entries.select(F.substring_index("file", "/", 1).alias("attempt")).distinct().collect()}
    system, root = FileSystem.from_uri(place)
    for found in system.get_file_info(FileSelector(f"{root}/files")):
        if found.base_name not in accepted:
            system.delete_dir(found.path)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """`path`, `file` (below `<folder>/files`), `n_bytes`, `sha256` of a published export; raises while there is none."""
    return spark.read.schema(MANIFEST).parquet(f"{_place(folder)}/manifest")


def read_exported(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with the `content` of each file; null where a file is gone.

    The manifest names the files, so executors open them by name: no folder is listed.
    """
    place = f"{_place(folder)}/files"
    return readers.read_files(read_manifest(spark, folder), place, "file").select(
        "path", "file", "n_bytes", "sha256", "content")
