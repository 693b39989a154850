"""Open records: fields that no schema knows pass through reading, choosing, editing and writing."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlspark.functions.identity import document_id
from crawlspark.operators import open_records
from crawlspark.operators.dedup import dedup_index
from crawlspark.operators.links import relinked_chunks
from crawlspark.plans import tasks
from crawlspark.schemas import CRAWL_CONTENT
from crawlspark.sources import readers, writers

PAGE = {"_id": "1", "url": "http://a.org/", "raw_content": "x", "deep": {"list": [1, {"k": None}], "name with ' and \"": "é\n"}, "big": 2**80}
COPY = {**PAGE, "_id": "2", "deep": None}
IMAGE = {"_id": "3", "url": "http://a.org/i.png", "content_type": "image/png", "obj_parent": "http://a.org/",
         "crawl_data": {"inlinks": ["http://a.org/", "http://a.org/b,c"], "more": 1}, "n_inlinks": 9, "score": 0.25}
BARE = {"_id": "4", "content_type": "image/gif", "url": 7, "crawl_data": None}


def text_of(*documents) -> str:
    return "".join(json.dumps(document) + "\n" for document in documents)


@pytest.fixture
def dump(tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    (folder / "part-00000").write_text(text_of(PAGE, IMAGE) + "\n  \n")
    (folder / "part-00001").write_text(text_of(COPY, BARE))
    return str(folder)


def documents_in(path) -> list[dict]:
    files = [file for file in sorted(Path(path).rglob("part-*")) if file.is_file()]
    return sorted((json.loads(line) for file in files for line in file.read_text().splitlines()), key=lambda doc: doc["_id"])


def test_deduplicating_keeps_every_field(spark, dump, tmp_path):
    for exact in (False, True):
        tasks.build_dedup_index(spark, dump_dir=dump, output_dir=f"{tmp_path}/index-{exact}")
        tasks.deduplicate(spark, dump_dir=dump, hash_dir=f"{tmp_path}/index-{exact}", output_dir=f"{tmp_path}/out-{exact}", exact=exact)
        assert documents_in(f"{tmp_path}/out-{exact}") == [PAGE, IMAGE, BARE]
    assert {path.name for path in (tmp_path / "out-True").glob("part=*")} == {"part=part-00000", "part=part-00001"}


def test_exact_index_tells_open_documents_apart_by_all_their_fields(spark):
    lines = [("p", json.dumps(document)) for document in (PAGE, PAGE, {**PAGE, "deep": 1})]
    documents = open_records.open_documents(spark.createDataFrame(lines, "path string, value string"))
    index = dedup_index(open_records.document_view(documents, "_id", "url", "raw_content"))
    assert open_records.keep_indexed(documents, index, exact=True).count() == 1
    assert open_records.keep_indexed(documents, index).count() == 3


def test_relinking_replaces_two_fields_only(spark, dump, tmp_path):
    page = spark.createDataFrame([("http://a.org/", "text/html", b"x", "Tue, 30 Aug 2016 18:00:00 GMT")], CRAWL_CONTENT)
    page.write.parquet(f"{tmp_path}/segments/s/content")
    tasks.relink_dumped_images(spark, segment_dir=f"{tmp_path}/segments", dump_dir=dump, output_dir=f"{tmp_path}/out")
    one = spark.range(1).select(document_id(F.lit("http://a.org/"), F.lit("1472580000000")), document_id(F.lit("http://a.org/b,c"), F.lit(None))).first()
    expected = {**IMAGE, "obj_parent": one[0], "crawl_data": {"inlinks": sorted(one)}}
    # A field without a value is left out, as everywhere in written documents.
    bare = {name: value for name, value in BARE.items() if value is not None}
    assert documents_in(f"{tmp_path}/out") == [expected, bare]


def test_fields_views_and_edits(spark):
    lines = [(json.dumps(PAGE),), ('{"a": [1, "x"], "b": {"c": 1.10}, "d.e": true}',), ("{}",)]
    documents = open_records.open_documents(spark.createDataFrame(lines, "value string"))
    field = lambda name, kind="string": open_records.document_field(F.col("doc"), name, kind)
    rows = documents.select(field("big", "decimal(38,0)"), field("a"), field("a", "array<string>"), field("d.e"), field("b", "int"),
                            F.array_join(open_records.field_names(F.col("doc")), " ")).collect()
    assert tuple(rows[0]) == (2**80, None, None, None, None, "_id big deep raw_content url")
    assert tuple(rows[1]) == (None, '[1,"x"]', ["1", "x"], "true", None, "a b d.e") and tuple(rows[2])[-1] == ""
    edits = {"b": F.lit("new"), "z": F.struct(F.array(F.lit(1)).alias("y")), "a": F.lit(None).cast("string"), "n": F.lit(2)}
    edited = [json.loads(row.value) for row in open_records.document_lines(documents.select(
        open_records.with_fields(F.col("doc"), edits).alias("doc"))).collect()]
    added = {"b": "new", "z": {"y": [1]}, "n": 2}
    assert edited == [{**PAGE, **added}, {"d.e": True, **added}, added]


@pytest.mark.parametrize("line", ["not json", '{"a": 1, "a": 2}', '{"a": '])
def test_bad_lines_raise(spark, tmp_path, line):
    (tmp_path / "part-00000").write_text(line + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_open_dump(spark, str(tmp_path)).collect()


def test_written_parts_refuse_a_path_that_exists(spark, dump):
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_document_parts(readers.read_open_dump(spark, dump), dump)


def test_empty_dump(spark, tmp_path):
    (tmp_path / "part-00000").write_text("\n")
    documents = readers.read_open_dump(spark, str(tmp_path))
    assert documents.count() == 0 and documents.columns == ["path", "doc"]


def test_relinked_chunks_hold_every_inlink_of_a_hub(spark):
    edges = [("hub", f"http://h/{n % 3000}") for n in range(4000)] + [("x", "http://h/1"), ("y", None), (None, "z")]
    times = spark.createDataFrame([(f"http://h/{n}", str(n)) for n in range(0, 3000, 2)], "url string, timestamp string")
    chunks = relinked_chunks(spark.createDataFrame(edges, "to_url string, from_url string"), times, chunk_size=100, slices=16)
    rows = chunks.collect()
    named = spark.range(3000).select(F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"), F.when(
        F.col("id") % 2 == 0, F.col("id").cast("string")).alias("t"))
    ids = {row[0]: row[1] for row in named.select("url", document_id(F.col("url"), F.col("t"))).collect()}
    hub = [row for row in rows if row.url == "hub"]
    assert sorted(link for row in hub for link in row.inlink_ids) == sorted(ids.values())
    assert {row.n_inlinks for row in hub} == {3000} and max(len(row.inlink_ids) for row in hub) < 300
    assert [row.inlink_ids for row in rows if row.url == "x"] == [[ids["http://h/1"]]]
