"""The catalogue opens what is asked for, the rejected move no document, the manifest lists each image once."""

import hashlib
import os
import re
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from crawlspark.fixed_values import TEXT_MIME_TYPES
from crawlspark.operators.dedup import apply_dedup_index, dedup_index
from crawlspark.operators.rejected import drop_rejected, rejected_index
from crawlspark.schemas import CRAWL_CONTENT
from crawlspark.sources import catalogue, manifest

ROOT = Path(__file__).resolve().parent.parent


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- catalogue ---

def _content(spark, *rows):
    return spark.createDataFrame(rows, CRAWL_CONTENT)


@pytest.fixture
def crawl(spark, tmp_path):
    root = f"{tmp_path}/catalogue"
    rows = _content(spark, ("a", "text/html", b"<p>", None), ("i", "image/png", b"\x89\xff", None), (None, None, None, None))
    catalogue.write_catalogue(rows.selectExpr("*", "'007' as segment"), root)
    catalogue.write_segment(_content(spark, ("b", "text/plain", b"b", "d"), ("j", "image/png", b"", None)), root, "s-2")
    return root


def test_segments_come_back_whole(spark, crawl):
    found = catalogue.read_catalogue(spark, crawl).selectExpr("url", "content_type", "hex(content)", "http_date", "segment", "kind")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("a", "text/html", "3C703E", None, "007", "text"), ("i", "image/png", "89FF", None, "007", "image"),
        (None, None, None, None, "007", "other"), ("b", "text/plain", "62", "d", "s-2", "text"),
        ("j", "image/png", "", None, "s-2", "image")], key=str)


def test_files_of_other_segments_and_kinds_are_not_opened(spark, crawl):
    broken = [path for path in Path(crawl).rglob("*.parquet") if "segment=007" in str(path) or "kind=image" in str(path)]
    assert len(broken) >= 4
    for path in broken:
        path.write_bytes(b"no parquet")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    found = catalogue.read_catalogue(spark, crawl, segments=["s-2", "s-2"], kinds=["text"])
    assert [row.url for row in found.collect()] == ["b"]
    assert all("segment=s-2" in file for file in found.inputFiles())
    assert re.search(r"PartitionFilters: \[[^\]]*kind#\d+ = text", plan_of(found))
    with pytest.raises(Exception):
        catalogue.read_catalogue(spark, crawl).collect()


def test_segments_are_added_once(spark, crawl):
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        catalogue.write_segment(_content(spark), crawl, "s-2")
    catalogue.write_segment(_content(spark), crawl, "empty")
    assert catalogue.read_catalogue(spark, crawl, segments=["s-2", "empty"]).count() == 2
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        catalogue.read_catalogue(spark, crawl, segments=["missing"])
    for wrong in ("", "a/b", "..", "a b"):
        with pytest.raises(ValueError):
            catalogue.write_segment(_content(spark), crawl, wrong)
    with pytest.raises(ValueError):
        catalogue.read_catalogue(spark, crawl, segments=[])
    with pytest.raises(ValueError):
        catalogue.read_catalogue(spark, crawl, kinds=["video"])


def test_sizes_need_no_data(spark, crawl):
    sizes = catalogue.catalogue_sizes(catalogue.read_catalogue(spark, crawl))
    rows = {(row.segment, row.kind): (row.n_rows, row.n_files) for row in sizes.collect()}
    assert rows == {("007", "image"): (1, 1), ("007", "other"): (1, 1), ("007", "text"): (1, 1),
                    ("s-2", "image"): (1, 1), ("s-2", "text"): (1, 1)}
    assert "ReadSchema: struct<>" in plan_of(sizes)


def test_kinds_exclude_each_other():
    assert not any("image" in kind for kind in TEXT_MIME_TYPES)


# --- index of the rejected ---

DUMP = [("file:///d/part-0", "1", "u", "x"), ("file:///d/part-1", "1", "u", "x"), ("file:///d/part-1", "2", "v", "x"),
        ("file:///d/part-1", "2", "v", "x"), ("file:///d/part-1", "3", "v", "x"), ("file:///d/part-2", "4", None, None),
        ("file:///d/part-2", "5", None, None), ("file:///d/part-2", None, "w", "y"), (None, "6", "z", "y")]


def test_rejected_and_kept_are_the_whole_dump(spark, tmp_path):
    dump = spark.createDataFrame(DUMP, "path string, _id string, url string, raw_content string")
    index = dedup_index(dump)
    rejected = rejected_index(dump, index)
    assert sorted(map(tuple, rejected.collect())) == [("/d/part-1", "1"), ("/d/part-1", "3"), ("/d/part-2", "5")]
    rejected.write.parquet(f"{tmp_path}/rejected")
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    kept = sorted(map(tuple, apply_dedup_index(dump, index).collect()), key=str)
    for bound in (1 << 20, 0):
        assert sorted(map(tuple, drop_rejected(dump, rejected, bound).collect()), key=str) == kept
    none = dump.limit(0)
    assert rejected_index(none, dedup_index(none)).count() == 0 and drop_rejected(none, rejected).count() == 0
    assert drop_rejected(dump, rejected.limit(0)).count() == 7


def test_documents_stay_where_they_are(spark, tmp_path):
    dump = spark.createDataFrame(DUMP, "path string, _id string, url string, raw_content string")
    dump.write.parquet(f"{tmp_path}/dump")
    rejected_index(dump, dedup_index(dump)).write.parquet(f"{tmp_path}/rejected")
    plan = plan_of(drop_rejected(spark.read.parquet(f"{tmp_path}/dump"), spark.read.parquet(f"{tmp_path}/rejected")))
    assert "LeftAnti" in plan and "BroadcastExchange" in plan and not re.search(r"(?<!Broadcast)Exchange", plan)


# --- manifest ---

def test_images_come_back_by_path(spark, tmp_path):
    odd = "a:b/../c d/" + "x" * 300
    rows = [("p", b"\x89\xff\x00"), ("p", b"\x89\xff\x00"), ("p", b"other"), (odd, b""), ("", b"no path"), ("no content", None)]
    folder = f"{tmp_path}/out"
    assert manifest.export_with_manifest(spark.createDataFrame(rows, "path string, content binary"), folder) == 2
    least = min(b"\x89\xff\x00", b"other", key=lambda body: hashlib.sha256(body).hexdigest())
    found = {row.path: row for row in manifest.read_exported(spark, folder).collect()}
    assert {path: bytes(row.content) for path, row in found.items()} == {"p": least, odd: b""}
    assert all(row.sha256 == hashlib.sha256(row.content).hexdigest() and row.n_bytes == len(row.content) for row in found.values())
    files = [path for path in Path(folder, "files").rglob("*") if path.is_file() and not path.name.startswith(".")]
    assert sorted(str(path.relative_to(f"{folder}/files")) for path in files) == sorted(row.file for row in found.values())
    with pytest.raises(FileExistsError):
        manifest.export_with_manifest(spark.createDataFrame(rows, "path string, content binary"), folder)


def test_an_export_of_nothing(spark, tmp_path):
    images = spark.createDataFrame([], "path string, content binary")
    assert manifest.export_with_manifest(images, f"{tmp_path}/out") == 0
    assert manifest.read_exported(spark, f"{tmp_path}/out").count() == 0


def test_an_export_that_fails_publishes_nothing(spark, tmp_path):
    images = spark.range(4).selectExpr("cast(id as string) as path",
                                       "if(id = 3, raise_error('broken'), unhex('FF')) as content")
    with pytest.raises(Exception, match="broken"):
        manifest.export_with_manifest(images, f"{tmp_path}/out")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        manifest.read_manifest(spark, f"{tmp_path}/out")


RETRIED = """
import sys, time
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from crawlspark.sources import manifest

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate())

def images(batches):
    for place, batch in enumerate(batches):
        if place == 3 and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
            time.sleep(3)  # until the batches before are written
            raise RuntimeError("lost")
        ids = batch.column("id").to_pylist()
        yield pa.RecordBatch.from_pydict({"path": [f"p/{i}" for i in ids], "content": [b"\\xff%d" % i for i in ids]})

rows = spark.range(0, 100, 1, 2).mapInArrow(images, "path string, content binary")
n = manifest.export_with_manifest(rows, sys.argv[1])
whole = manifest.read_exported(spark, sys.argv[1]).where("sha2(content, 256) = sha256").count()
print("RESULT", n, whole)
"""


def test_a_task_that_is_run_again_leaves_each_file_once(tmp_path):
    folder = tmp_path / "out"
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(RETRIED), str(folder)], capture_output=True, text=True, timeout=240,
                         env=os.environ | {"PYTHONPATH": f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"})
    assert "RESULT 100 100" in run.stdout, run.stderr[-2000:]
    assert "lost" in run.stderr
    files = [path for path in (folder / "files").rglob("*") if path.is_file() and not path.name.startswith(".")]
    assert len(files) == 100 and len(list((folder / "files").iterdir())) == 2
