"""Tasks from path to path: read what was written, and refuse what exists."""

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from crawlspark.operators.records import RunLabels
from crawlspark.plans import tasks
from crawlspark.schemas import CRAWL_CONTENT, CRAWL_DB, CRAWL_LINKS
from crawlspark.sources import manifest, readers, writers

DATE = "Tue, 30 Aug 2016 18:00:00 GMT"
PAGE = ("<html><head><title>T</title></head><body>" + "apple pie " * 20 + "</body></html>").encode()
LABELS = RunLabels("webpage", "c", "t")


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest().upper()


@pytest.fixture(scope="module")
def crawl(spark, tmp_path_factory):
    """A small crawl on disk: two segments, a link graph, crawl state, a knowledge base."""
    root = tmp_path_factory.mktemp("crawl")
    first = [("http://www.h.org/a", "text/html", PAGE, DATE), ("http://h.org/i.png", "image/png", b"\x89\xff\x00", DATE),
             ("http://h.org/b", "text/html", b"", None)]
    second = [("http://www.h.org/a", "text/html", PAGE, DATE), ("http://o.org/c", "text/plain", b"pear " * 40, "bad")]
    for name, rows in (("s1", first), ("s2", second)):
        df = spark.createDataFrame(rows, CRAWL_CONTENT)
        df.coalesce(1).write.parquet(f"{root}/segments/{name}/content")
        # Another data set of the same segment, with a different schema; it must not be read.
        spark.range(3).write.parquet(f"{root}/segments/{name}/parse_text")
    edges = [("http://h.org/i.png", "http://www.h.org/a"), ("http://www.h.org/a", "http://h.org/b")]
    spark.createDataFrame(edges, CRAWL_LINKS).write.parquet(f"{root}/linkdb/current")
    state = [("http://www.h.org/a", "db_fetched", 1472580000000, 1.0, 86400, 0, {"pst": "x=5"}),
             ("http://h.org/i.png", "db_gone", 1472580000000, 0.0, 86400, 0, None)]
    spark.createDataFrame(state, CRAWL_DB).write.parquet(f"{root}/crawldb/current")
    (root / "kb.txt").write_text("k1|_|apple tart\nk2|_|pear the tree|_|ignored\nwithout delimiter\n")
    (root / "stop.txt").write_text("The\n tart \n\n")
    return root


def lines(path) -> list[str]:
    return [line for file in sorted(Path(path).rglob("part-*")) if file.is_file()
            for line in file.read_text().splitlines()]


def test_segment_scan(spark, crawl):
    content = readers.read_content(spark, f"{crawl}/segments")
    assert content.count() == 5
    assert {row.segment for row in content.select("segment").collect()} == {"s1", "s2"}
    (crawl / "list.txt").write_text(f"{crawl}/segments/s2/content\n\n")
    listed = readers.read_content(spark, segment_file=f"{crawl}/list.txt")
    assert listed.count() == 2 and listed.first().segment == "s2"
    (crawl / "empty.txt").write_text("\n")
    with pytest.raises(ValueError):
        readers.read_content(spark, segment_file=f"{crawl}/empty.txt")
    with pytest.raises(AnalysisException):
        readers.read_content(spark, segment_file=f"{crawl}/missing.txt")
    with pytest.raises(ValueError):
        readers.read_content(spark)


def test_other_formats(spark, crawl, tmp_path):
    links = readers.read_links(spark, f"{crawl}/linkdb")
    for fmt in ("orc", "json"):
        links.write.format(fmt).save(f"{tmp_path}/{fmt}/current")
        again = readers.read_links(spark, f"{tmp_path}/{fmt}", fmt=fmt)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, links.collect()))
    with pytest.raises(ValueError):
        readers.read_links(spark, f"{tmp_path}/orc", fmt="avro")


def test_knowledge_base_and_stop_words(spark, crawl):
    kb = readers.read_knowledge_base(spark, f"{crawl}/kb.txt")
    assert [tuple(row) for row in kb.collect()] == [
        ("k1", "apple tart"), ("k2", "pear the tree"), ("without delimiter", "")]
    words = readers.read_stop_words(spark, f"{crawl}/stop.txt")
    assert sorted(row.word for row in words.collect()) == ["tart", "the"]
    assert readers.read_stop_words(spark).where("word = 'the'").count() == 1


def test_dump_then_deduplicate(spark, crawl, tmp_path):
    out = f"{tmp_path}/dump"
    tasks.dump_linked(spark, max_inlinks=5000, segment_dir=f"{crawl}/segments", link_db=f"{crawl}/linkdb", output_dir=out, labels=LABELS)
    docs = [json.loads(line) for line in lines(out)]
    assert sorted(doc["url"] for doc in docs) == ["http://h.org/i.png", "http://www.h.org/a", "http://www.h.org/a"]
    image = next(doc for doc in docs if doc["content_type"] == "image/png")
    assert image["obj_parent"] == "http://www.h.org/a" and image["crawl_data"] == {"inlinks": ["http://www.h.org/a"]}
    assert all("obj_parent" not in doc for doc in docs if doc is not image)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        tasks.dump_linked(spark, max_inlinks=5000, segment_dir=f"{crawl}/segments", link_db=f"{crawl}/linkdb", output_dir=out,
                          labels=LABELS)

    read = readers.read_dump(spark, out)
    assert read.count() == 3 and read.where("path like '%/dump/part-%'").count() == 3
    tasks.build_dedup_index(spark, dump_dir=out, output_dir=f"{tmp_path}/index")
    assert readers.read_dedup_index(spark, f"{tmp_path}/index").count() == 2
    tasks.deduplicate(spark, dump_dir=out, hash_dir=f"{tmp_path}/index", output_dir=f"{tmp_path}/exact", exact=True)
    kept = [json.loads(line) for line in lines(f"{tmp_path}/exact")]
    assert sorted(doc["url"] for doc in kept) == ["http://h.org/i.png", "http://www.h.org/a"]
    assert all(path.name.startswith("part=part-") for path in Path(f"{tmp_path}/exact").glob("part=*"))

    tasks.relink_dumped_images(spark, segment_dir=f"{crawl}/segments", dump_dir=out, output_dir=f"{tmp_path}/linked")
    relinked = [json.loads(line) for line in lines(f"{tmp_path}/linked")]
    parent = sha("http://www.h.org/a-1472580000000")
    assert [(doc["obj_parent"], doc["crawl_data"]) for doc in relinked] == [(parent, {"inlinks": [parent]})]


def test_deduplicate_by_the_rejected(spark, crawl, tmp_path):
    out = f"{tmp_path}/dump"
    tasks.dump_linked(spark, max_inlinks=5000, segment_dir=f"{crawl}/segments", link_db=f"{crawl}/linkdb", output_dir=out, labels=LABELS)
    tasks.build_dedup_index(spark, dump_dir=out, output_dir=f"{tmp_path}/index")
    tasks.deduplicate(spark, dump_dir=out, hash_dir=f"{tmp_path}/index", output_dir=f"{tmp_path}/kept")
    tasks.build_rejected_index(spark, dump_dir=out, hash_dir=f"{tmp_path}/index", output_dir=f"{tmp_path}/rejected")
    tasks.deduplicate_rejected(spark, dump_dir=out, rejected_dir=f"{tmp_path}/rejected", output_dir=f"{tmp_path}/left")
    left = [json.loads(line) for line in lines(f"{tmp_path}/left")]
    assert sorted(left, key=str) == sorted((json.loads(line) for line in lines(f"{tmp_path}/kept")), key=str)
    assert all("n_inlinks" in doc for doc in left)


def test_images_of_a_catalogue(spark, crawl, tmp_path):
    tasks.build_catalogue(spark, segment_dir=f"{crawl}/segments", output_dir=f"{tmp_path}/catalogue")
    assert tasks.export_images_with_manifest(spark, catalogue_dir=f"{tmp_path}/catalogue", output_dir=f"{tmp_path}/out") == 1
    row = manifest.read_exported(spark, f"{tmp_path}/out").first()
    assert (row.path, bytes(row.content)) == (sha("http://h.org/i.png-1472580000000"), b"\x89\xff\x00")
    # A segment without images.
    assert tasks.export_images_with_manifest(spark, catalogue_dir=f"{tmp_path}/catalogue", segments=["s2"], by="path",
                                             output_dir=f"{tmp_path}/none") == 0


def test_dump_line_that_is_no_json_raises(spark, tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    (folder / "part-00000").write_text('{"_id": "1"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_dump(spark, str(folder)).collect()


def test_unlinked_dump(spark, crawl, tmp_path):
    tasks.dump_unlinked(spark, segment_dir=f"{crawl}/segments", link_db=f"{crawl}/linkdb",
                        output_dir=f"{tmp_path}/out", labels=LABELS)
    docs = [json.loads(line) for line in lines(f"{tmp_path}/out")]
    assert [doc["url"] for doc in docs] == ["http://o.org/c"]
    assert docs[0]["_id"] == sha("http://o.org/c-null") and docs[0]["obj_stored_url"].startswith("org/o/")


def test_index_dump(spark, crawl, tmp_path):
    tasks.dump_index(spark, max_inlinks=5000, segment_dir=f"{crawl}/segments", link_db=f"{crawl}/linkdb", crawl_db=f"{crawl}/crawldb",
                     crawl_id="run", output_dir=f"{tmp_path}/out")
    docs = [json.loads(line) for line in lines(f"{tmp_path}/out")]
    assert sorted(doc["url"] for doc in docs) == ["http://h.org/i.png", "http://www.h.org/a", "http://www.h.org/a"]
    assert next(doc for doc in docs if "raw_content" in doc)["title_t_md"] == "T"


def test_images(spark, crawl, tmp_path):
    tasks.export_images(spark, segment_dir=f"{crawl}/segments", output_dir=f"{tmp_path}/by_id")
    name = sha("http://h.org/i.png-1472580000000")
    assert (tmp_path / "by_id" / name).read_bytes() == b"\x89\xff\x00"
    tasks.export_images(spark, segment_dir=f"{crawl}/segments", output_dir=f"{tmp_path}/by_path", by="path")
    files = [path for path in (tmp_path / "by_path").rglob("*") if path.is_file()]
    assert [str(path.relative_to(tmp_path / "by_path")) for path in files] == [f"org/h/{sha('http://h.org/i.png')}"]
    with pytest.raises(FileExistsError):
        tasks.export_images(spark, segment_dir=f"{crawl}/segments", output_dir=f"{tmp_path}/by_id")


def test_images_of_one_path_and_paths_that_lead_upwards(spark, tmp_path):
    rows = [("a/x", b"one"), ("a/x", b"one"), ("a/x", b"two"), ("a/../../y", b"three"), ("", b"four"), ("b", None), ("c", b"")]
    images = spark.createDataFrame(rows, "path string, content binary").repartition(3)
    least = min((b"one", b"two"), key=lambda content: hashlib.sha256(content).hexdigest())
    assert writers.export_images(images, f"file://{tmp_path}/out") == 2 + (2 if least == b"one" else 1)
    files = {str(path.relative_to(tmp_path)): path.read_bytes() for path in tmp_path.rglob("*") if path.is_file()}
    assert files == {"out/a/x": least, "out/a/%2E%2E/%2E%2E/y": b"three", "out/c": b""}


def test_statistics(spark, crawl, tmp_path):
    tasks.crawl_statistics(spark, segment_dir=f"{crawl}/segments", output_dir=f"{tmp_path}/out")
    assert [tuple(row) for row in spark.read.parquet(f"{tmp_path}/out/host_urls").orderBy("host").collect()] == [
        ("h.org", 2), ("o.org", 1)]
    assert tuple(spark.read.parquet(f"{tmp_path}/out/totals").first()) == (2, 3)
    assert spark.read.parquet(f"{tmp_path}/out/all_segments").count() == 5


def test_rankings(spark, crawl, tmp_path):
    common = {"segment_dir": f"{crawl}/segments", "knowledge_base": f"{crawl}/kb.txt"}
    tasks.rank_pages(spark, **common, stop_words=f"{crawl}/stop.txt", output_dir=f"{tmp_path}/pages")
    rows = [line.split(",") for line in lines(f"{tmp_path}/pages")]
    assert sorted(row[1] for row in rows) == ["http://h.org/b", "http://o.org/c", "http://www.h.org/a",
                                              "http://www.h.org/a"]
    assert all(float(row[2]) > 0 for row in rows if row[1] != "http://h.org/b")
    tasks.rank_hosts(spark, **common, output_dir=f"{tmp_path}/hosts")
    report = lines(f"{tmp_path}/hosts")
    assert [line.split(" - ")[0] for line in report] == ["o.org", "h.org"]
    tasks.rank_top_domains(spark, **common, output_dir=f"{tmp_path}/top")
    assert len(lines(f"{tmp_path}/top")) == 3


def test_null_fields_are_written_on_request(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "k string, v string")
    writers.write_json(df, f"{tmp_path}/without")
    writers.write_json(df, f"{tmp_path}/with", keep_nulls=True)
    assert lines(f"{tmp_path}/without") == ['{"k":"a"}']
    assert lines(f"{tmp_path}/with") == ['{"k":"a","v":null}']
