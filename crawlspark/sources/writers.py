"""Sinks. Every writer refuses a path that exists."""

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.identity import plain_path
from crawlspark.operators.joins import lookup_join
from crawlspark.operators.open_records import document_lines


def json_lines(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """`value`: the line that `write_json` writes for each row."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def write_json(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """One JSON object per line. Null fields are left out unless `keep_nulls`."""
    df.write.mode("errorifexists").option("ignoreNullFields", not keep_nulls).json(path)


def index_json(index: DataFrame) -> Column:
    """A search-index record as one flat JSON object: dynamic fields stand beside the fixed ones."""
    dynamic = [name for name in index.columns if name.startswith("md_")]
    fixed = [name for name in index.columns if name not in dynamic]
    inner = F.regexp_extract(F.to_json(F.struct(*fixed)), r"(?s)^\{(.*)\}$", 1)
    parts = [inner] + [
        F.regexp_extract(F.coalesce(F.to_json(name), F.lit("{}")), r"(?s)^\{(.*)\}$", 1) for name in dynamic]
    filled = F.filter(F.array(*parts), lambda part: part != "")
    return F.concat(F.lit("{"), F.array_join(filled, ","), F.lit("}"))


def write_index(index: DataFrame, path: str) -> None:
    """Search-index records, one flat JSON object per line."""
    index.select(index_json(index).alias("value")).write.mode("errorifexists").text(path)


#: Documents that one compressed file of `write_parts` holds at most: it is read by one task.
LINES_PER_FILE = 200_000
#: Files that one task of `write_parts` keeps open; with more parts than that, its rows are sorted by part.
OPEN_FILES = 32


def write_parts(df: DataFrame, path: str) -> None:
    """Dumped documents in one folder per input part (`part=<file name>`), in one job, as gzipped JSON lines.

    Documents are written where they were read. No row is moved, and none is sorted while a task meets few parts;
    a large part is written by all tasks that read from it.
    """
    part = F.regexp_extract(plain_path(F.col("path")), r"([^/]*)$", 1)
    named = df.withColumn("part", part).drop("path")
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FILES)
    try:
        named.write.mode("errorifexists").partitionBy("part").options(
            compression="gzip", maxRecordsPerFile=LINES_PER_FILE, **{"zlib.compress.level": "BEST_SPEED"}).json(path)
    finally:
        conf.set(name, before)


def write_document_parts(documents: DataFrame, path: str) -> None:
    """Open documents (`path`, `doc`), whole, in one folder per input part, like `write_parts`."""
    part = F.regexp_extract(plain_path(F.col("path")), r"([^/]*)$", 1)
    lines = document_lines(documents.withColumn("part", part).drop("path"))
    lines.hint("rebalance", "part").write.mode("errorifexists").partitionBy("part").text(path)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet table: merged segments, dedup index, scores, images."""
    df.write.mode("errorifexists").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").csv(path)


def write_host_report(ranked_hosts: DataFrame, path: str) -> None:
    """Lines `host - score` in the order of the ranking; file names sort in that order."""
    line = F.concat(F.col("host"), F.lit(" - "), F.col("score").cast("string"))
    ranked_hosts.select(line.alias("value")).write.mode("errorifexists").text(path)


def one_image_per_path(images: DataFrame) -> DataFrame:
    """`path`, `content` of images that have both; of several contents, those whose hash is smallest stay.

    Clashes are found on paths and hashes alone, and the losing ones taken out: while they are
    few, no image is moved. Runs one aggregate job that measures them. Equal images
    of one path all stay.
    """
    named = images.where((F.col("path") != "") & F.col("content").isNotNull()).select(
        "path", F.col("content").cast("binary").alias("content"), F.unhex(F.sha2(F.col("content"), 256)).alias("hash"))
    hashes = named.select("path", "hash").distinct()
    clashing = hashes.groupBy("path").agg(F.min("hash").alias("least"), F.count("*").alias("n")).where("n > 1")
    losing = hashes.join(clashing, "path").where("hash <> least").select("path", "hash")
    return lookup_join(named, losing, ["path", "hash"], "left_anti").select("path", "content")


#: Names that one folder holds, about. ext4 refuses more in a folder after some 5.5 million image names.
NAMES_PER_FOLDER = 100_000


def _safe(path: Column) -> Column:
    """A path that stays below its folder: steps upwards are percent-encoded, as are names like those of `_dealt_files`."""
    parts = F.transform(F.filter(F.split(path, "/"), lambda part: ~part.isin("", ".")),
                        lambda part: F.when(part == "..", "%2E%2E").when(
                            part.rlike("^~[0-9]+$"), F.concat(F.lit("%7E"), F.substring(part, 2, 1 << 30))).otherwise(part))
    return F.array_join(parts, "/")


def _exported(images: DataFrame) -> DataFrame:
    return images.where((F.col("path") != "") & F.col("content").isNotNull())


def _folder(file: Column) -> Column:
    """The folder of a file, with a slash behind it; empty for a file in the top folder."""
    return F.regexp_extract(file, "^(.*/)?", 0)


def _dealt_files(paths: DataFrame, images: DataFrame) -> DataFrame:
    """`paths` with the `file` below the export's folder that each `path` of `images` is written to.

    That is the path itself, but names of a folder that gets more than `NAMES_PER_FOLDER` of them are dealt to
    folders `~<number>` in it by their hash. There are few such folders, however many names, so they are broadcast.
    """
    crowded = _exported(images).groupBy(_folder(_safe(F.col("path"))).alias("__folder")).agg(F.count("*").alias("n")).where(
        F.col("n") > NAMES_PER_FOLDER).select("__folder", F.ceil(F.col("n") / NAMES_PER_FOLDER).alias("__folders"))
    placed = paths.withColumn("__file", _safe(F.col("path"))).withColumn("__folder", _folder(F.col("__file"))).join(
        F.broadcast(crowded), "__folder", "left")
    name = F.substring_index("__file", "/", -1)
    below = F.concat("__folder", F.lit("~"), F.pmod(F.xxhash64(name), F.col("__folders")).cast("string"), F.lit("/"), name)
    return placed.select(*paths.columns, F.coalesce(below, "__file").alias("file"))


def exported_names(images: DataFrame) -> DataFrame:
    """`path`: the paths below its folder, once each, of the images that `export_images` writes."""
    return _exported(images).select(_safe(F.col("path")).alias("path")).distinct()


def exported_files(images: DataFrame) -> DataFrame:
    """`path`, `file`: `exported_names` and the file below its folder that holds each."""
    return _dealt_files(exported_names(images), images)


def export_images(images: DataFrame, folder: str) -> int:
    """Write each image to `<folder>/<path>` from the executors; returns how many were written.

    Names of folders that would hold more than `NAMES_PER_FOLDER` are dealt to folders below; `exported_files` tells where.

    `folder` is a local path or a URI that `pyarrow.fs` opens (`file`, `hdfs`, `s3`, `gs`). All executors must
    see it: the driver leaves a mark there, and a task that does not find it fails. A file is written
    under a passing name and then moved, so a task that is run again replaces its
    own files and a reader never sees half of one. Steps upwards in a path are encoded.
    """
    place = folder if "://" in folder else os.path.abspath(folder)
    system, root = FileSystem.from_uri(place)
    if system.get_file_info(root).type != FileType.NotFound:
        raise FileExistsError(folder)
    system.create_dir(root)
    mark = f".mark-{uuid.uuid4().hex}"
    system.open_output_stream(f"{root}/{mark}").close()

    def write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(place)
        if system.get_file_info(f"{root}/{mark}").type != FileType.File:
            raise FileNotFoundError(f"{folder} is not shared with this executor")
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content")):
                target = f"{root}/{file.as_py()}"
                passing = f"{target}.{uuid.uuid4().hex}.tmp"
                system.create_dir(target.rpartition("/")[0])
                try:
                    with system.open_output_stream(passing) as out:
                        out.write(content.as_buffer())
                    try:
                        system.move(passing, target)
                    except OSError:
                        # Some stores do not move onto a file, as one left by an earlier attempt.
                        system.delete_file(target)
                        system.move(passing, target)
                except BaseException:
                    if system.get_file_info(passing).type == FileType.File:
                        system.delete_file(passing)
                    raise
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    try:
        placed = _dealt_files(one_image_per_path(images), images)
        written = placed.mapInArrow(write_batches, "n bigint")
        return written.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    finally:
        system.delete_file(f"{root}/{mark}")
