"""What must not grow faster than the input: bodies moved, memory of one task, names in the driver."""

import hashlib
import os
import re
from collections import Counter

from pyspark.sql import functions as F

from crawlqueries.spark_queries import QUERIES
from crawlspark.operators import dedup, joins, links, records, relevance
from crawlspark.sources import catalogue, manifest, readers, writers

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_dedup_moves_bodies_once_and_by_short_keys(spark):
    dump = spark.createDataFrame([("file:/d/part-0", "a", "u", "body")], "path string, _id string, url string, raw_content string")
    plan = plan_of(dedup.apply_dedup_index(dump, dedup.dedup_index(dump), exact=True))
    assert len(re.findall(r"\bExchange", plan)) == 3  # the index by hashes, the index by key, bodies
    assert not re.search(r"Exchange hashpartitioning\([^)]*(?:_id|row_hash)", plan)


def test_exact_dedup_keeps_one_of_equal_lines_and_tells_keys_apart(spark):
    rows = [("file:/d/part-0", "a", "u", "body"), ("file:/d/part-0", "a", "u", "body"), ("file:///d/part-0", "a", None, "body"),
            ("file:/d/part-0", "a", None, None), (None, "b", "u", "body"), ("file:/d/part-0", None, "w", "body"),
            ("file:/d/part-0", "c", "u", None), ("file:/d/part-1", "d", "u", None)]
    dump = spark.createDataFrame(rows, "path string, _id string, url string, raw_content string")
    index = spark.createDataFrame(
        [(row.path, row.doc_id, row.url_hash, row.content_hash) for row in dedup.dedup_index(dump.where("path is not null")).collect()],
        "path string, doc_id string, url_hash string, content_hash string")
    kept = Counter(tuple(row)[1:] for row in dedup.apply_dedup_index(dump, index, exact=True).collect())
    assert kept == Counter({("a", "u", "body"): 1, ("a", None, "body"): 1, ("a", None, None): 1, ("c", "u", None): 1})


def test_index_groups_short_urls_and_bytes(spark):
    low, high, long_url = "0" * 64, "F" * 64, "http://h/" + "x" * 90
    rows = [("file:/d/p1", high, "u", "b"), ("file:/d/p1", low, "u", "b"), ("file:/d/p1", "1", "u", "b"), ("file:/d/p1", "f" * 64, "u", "b"),
            ("file:/d/p2", low, long_url, "b"), ("file:/d/p1", "x", long_url, "b"), ("file:/d/p1", None, "n", "b"),
            ("file:/d/p1", low, "n", "b"), (None, high, "n", None), ("file:/d/p3", high, None, None), ("file:/d/p3", low, "", None),
            ("file:/d/p4", low + "\n", "l", "b"), ("file:/d/p4", low + "a", "l", "b")]
    dump = spark.createDataFrame(rows, "path string, _id string, url string, raw_content string")
    digest = lambda text: "" if text is None else hashlib.sha256(text.encode()).hexdigest().upper()
    expected = {}
    for path, doc_id, url, content in rows:
        # Nulls are smallest, in paths and in ids.
        kept = tuple((value is not None, value or "") for value in (path and path.replace("file:", ""), doc_id))
        expected[digest(url), digest(content)] = min(kept, expected.get((digest(url), digest(content)), kept))
    index = dedup.dedup_index(dump)
    for found in (index, dedup.settled_index(index)):
        assert Counter(map(tuple, found.collect())) == Counter(
            (path if has_path else None, doc_id if has_id else None, *hashes)
            for hashes, ((has_path, path), (has_id, doc_id)) in expected.items())
    assert "Exchange hashpartitioning(short_url" in plan_of(index)


def test_list_of_many_documents_is_met_in_several_places(spark, monkeypatch):
    monkeypatch.setattr(records, "DOCUMENTS_PER_LIST", 10)
    rows = [(str(n), "image/png", "p", (["p", "q"],)) for n in range(95)] + [(f"n{n}", "image/png", None, None) for n in range(25)] + [
        ("e", "image/png", None, ([],)), ("o", "image/png", "q", (["q"],))]
    dump = spark.createDataFrame(rows, "_id string, content_type string, obj_parent string, crawl_data struct<inlinks: array<string>>")
    times = spark.createDataFrame([("p", "5")], "url string, timestamp string")
    relinked = records.relink_images(dump.repartition(4), times)
    p, q = (hashlib.sha256(text).hexdigest().upper() for text in (b"p-5", b"q-null"))
    assert Counter((row._id, row.obj_parent, row.crawl_data and tuple(row.crawl_data.inlinks)) for row in relinked.collect()) == Counter(
        [(str(n), p, tuple(sorted([p, q]))) for n in range(95)] + [(f"n{n}", None, None) for n in range(25)] + [("e", None, ()), ("o", q, (q,))])
    plan = plan_of(relinked)
    assert plan.count("Exchange hashpartitioning(link_key") >= 2 and not re.search(r"Exchange hashpartitioning\(link_key[^)]*xxhash64", plan)


def test_terms_are_counted_within_their_text(spark):
    texts = spark.createDataFrame([(1, "b a b\tc a b"), (2, " \n "), (3, None), (4, "x")], "k bigint, text string")
    found = relevance.text_terms(texts, "k")
    assert "Exchange" not in plan_of(found) and "HashAggregate" not in plan_of(found)
    assert {(row.k, row.term, row.tf) for row in found.collect()} == {
        (row.k, row.term, row.tf) for row in relevance.term_counts(texts, "k").collect()}
    bucketed = relevance.text_terms(texts, "k", num_features=2)
    assert sorted(map(str, bucketed.collect())) == sorted(map(str, relevance.term_counts(texts, "k", num_features=2).collect()))


def test_texts_that_share_a_key_are_one(spark):
    texts = spark.createDataFrame([(1, "a b"), (1, "b"), (2, "b b"), (None, "c"), (None, "c d")], "k bigint, text string")
    assert Counter(map(tuple, relevance.document_terms(texts, "k").collect())) == Counter(
        [(1, "a", 1), (1, "b", 2), (2, "b", 2), (None, "c", 2), (None, "d", 1)])


def test_more_edges_make_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(links, "EDGES_PER_TASK", 10)
    edges = spark.range(400).select(F.concat(F.lit("t"), F.col("id") % 7).alias("to_url"),
                                    F.concat(F.lit("f"), F.col("id") % 130).alias("from_url"))
    sets = links.inlink_sets(edges, 3, slices=4)
    assert "hashpartitioning(to_url" in plan_of(sets) and ", 40)" in plan_of(sets)
    assert "HashAggregate(keys=[to_url" not in plan_of(sets).split("Window")[-1]
    expected = {}
    for row in edges.collect():
        expected.setdefault(row.to_url, set()).add(row.from_url)
    assert {row.url: (row.parent, row.inlinks, row.n_inlinks) for row in sets.collect()} == {
        url: (min(found), sorted(found)[:4], len(found)) for url, found in expected.items()}


def test_chunks_move_edges_once_to_their_target(spark, monkeypatch):
    monkeypatch.setattr(links, "EDGES_PER_TASK", 60)
    edges = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("t"), F.col("id") % 40)).alias("to_url"),
                                    F.concat(F.lit("f"), F.col("id") % 700).alias("from_url"))
    edges = edges.union(spark.createDataFrame([("t1", None), (None, "f1")], edges.schema))
    expected = {}
    for row in edges.dropna().collect():
        expected.setdefault(row.to_url, set()).add(row.from_url)
    assert len(expected["hub"]) > 60 > max(len(found) for url, found in expected.items() if url != "hub")
    chunks = links.inlink_chunks(edges, chunk_size=8, slices=4)
    rows = chunks.collect()
    assert len({(row.url, row.chunk) for row in rows}) == len(rows) and len([row for row in rows if row.url == "hub"]) > 20
    assert {url: {(row.n_inlinks, link) for row in rows if row.url == url for link in row.inlinks} for url in expected} == {
        url: {(len(found), link) for link in found} for url, found in expected.items()}
    assert sum(len(row.inlinks) for row in rows) == sum(map(len, expected.values()))
    times = spark.createDataFrame([("f1", "5")], "url string, timestamp string")
    assert len(re.findall(r"Exchange hashpartitioning\(to_url[^,]*, deal", plan_of(links.relinked_chunks(edges, times)))) == 1
    assert not re.search(r"Exchange hashpartitioning\([^)]*chunk", plan_of(links.relinked_chunks(edges, times)))


def test_joins_carry_no_hash_of_their_key(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("b", 5), ("c", 6), (None, 7)], "k string, y int")
    found = {how: Counter(map(tuple, joins.skew_safe_join(left, right, ["k"], how).collect())) for how in (
        "inner", "left", "full", "left_semi", "left_anti")}
    assert found == {
        "inner": Counter([("b", 2, 5)]), "left": Counter([("a", 1, None), ("b", 2, 5), (None, 3, None)]),
        "full": Counter([("a", 1, None), ("b", 2, 5), (None, 3, None), ("c", None, 6), (None, None, 7)]),
        "left_semi": Counter([("b", 2)]), "left_anti": Counter([("a", 1), (None, 3)])}
    counts = left.groupBy("k").agg(F.sum("x").alias("n"))
    for hint in ("merge", "shuffle_hash"):
        plan = plan_of(joins.skew_safe_join(left, counts.hint(hint), ["k"]))
        assert len(re.findall(r"Exchange hashpartitioning\(k[^,]*, xxhash64\(", plan)) == 1
        assert len(re.findall(r"Exchange hashpartitioning\(__right_k[^,]*, xxhash64\(", plan)) == 1
        assert "key_hash" not in plan
    again = joins.skew_safe_join(left, left.withColumn("z", F.col("x") + 1).select("k", "z"), ["k"])
    assert Counter(map(tuple, again.collect())) == Counter([("a", 1, 2), ("b", 2, 3)])


def test_files_are_read_by_name_without_listing(spark, tmp_path):
    rows = [("com/a", b"one"), ("../b", b"\xff"), ("com/./c", b""), ("com/a", b"one"), ("", b"x"), (None, b"x"), ("d", None)]
    images = spark.createDataFrame(rows, "path string, content binary")
    writers.export_images(images, f"{tmp_path}/out")
    names = writers.exported_names(images)
    stored = {os.path.relpath(os.path.join(top, name), f"{tmp_path}/out") for top, _, found in os.walk(f"{tmp_path}/out") for name in found
              if not name.startswith(".")}
    assert {row.path for row in names.collect()} == stored
    found = readers.read_files(names.union(spark.createDataFrame([("gone",)], "path string")), f"{tmp_path}/out", "path")
    assert {row.path: row.content for row in found.collect()} == {"com/a": b"one", "%2E%2E/b": b"\xff", "com/c": b"", "gone": None}
    manifest.export_with_manifest(images, f"{tmp_path}/listed")
    read = manifest.read_exported(spark, f"{tmp_path}/listed")
    assert "binaryFile" not in plan_of(read) and "FileScan binary" not in plan_of(read)
    assert {row.path: row.content for row in read.collect()} == {"com/a": b"one", "../b": b"\xff", "com/./c": b""}


def test_no_folder_of_images_gets_all_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "NAMES_PER_FOLDER", 50)
    crowd = spark.range(400).selectExpr("concat('com/site/', id) path", "cast(id as string) content")
    rows = [("com/~3/one", "a"), ("top", "b"), ("com/site/7/x", "c")]
    images = crowd.union(spark.createDataFrame(rows, "path string, content string")).union(crowd.where("id < 3"))
    images = images.withColumn("content", F.col("content").cast("binary"))
    assert writers.export_images(images, f"{tmp_path}/out") == 406
    names = {top: [name for name in found if not name.startswith(".")] for top, _, found in os.walk(f"{tmp_path}/out")}
    assert sum(map(len, names.values())) == 403 and max(map(len, names.values())) < 90
    files = readers.read_files(writers.exported_files(images), f"{tmp_path}/out", "file").collect()
    assert {(row.path, row.content) for row in files} == {
        *((f"com/site/{n}", str(n).encode()) for n in range(400)), ("com/%7E3/one", b"a"), ("top", b"b"), ("com/site/7/x", b"c")}
    assert {row.file for row in files} == {os.path.relpath(f"{top}/{name}", f"{tmp_path}/out") for top, found in names.items() for name in found}


def test_short_tables_are_dealt_out_before_work_on_them(spark):
    plan = plan_of(QUERIES["cdr_ids"](spark, SF))
    assert all(re.search(rf"hashpartitioning\({key}", plan) for key in ("o_orderkey", "p_partkey", "c_custkey"))


def test_dump_parts_are_small_and_written_where_rows_lie(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "LINES_PER_FILE", 10)
    monkeypatch.setattr(writers, "OPEN_FILES", 2)
    body = "a page of words " * 100
    dump = spark.range(0, 150, 1, 3).selectExpr("concat('file:///d/part-', id % 5) path", "cast(id as string) _id",
                                                f"concat('{body}', id) raw_content")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    writers.write_parts(dump, f"{tmp_path}/out")
    assert spark.conf.get(name) == before
    files = [os.path.join(top, name) for top, _, found in os.walk(f"{tmp_path}/out") for name in found if name.startswith("part-")]
    assert len(files) == 15 and all(file.endswith(".json.gz") for file in files)  # ten lines of each part in each task
    assert sum(map(os.path.getsize, files)) < 150 * len(body) / 5
    found = catalogue.read_dump_parts(spark, f"{tmp_path}/out").collect()
    assert {(row.part, row._id, row.raw_content) for row in found} == {
        (f"part-{n % 5}", str(n), f"{body}{n}") for n in range(150)} and len(found) == 150
    assert readers.read_dump(spark, f"{tmp_path}/out").count() == 150


def test_ranked_scores_are_made_once(spark, tmp_path, monkeypatch):
    settled = []
    monkeypatch.setattr(relevance, "settled", lambda df: settled.append(df) or df)
    scores = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "url string, score double")
    assert [row.url for row in relevance.ranked(scores, "url").collect()] == ["b", "a"] and settled == [scores]


def test_relinked_images_are_made_once_and_looked_up_by_bytes(spark, monkeypatch):
    made = []
    monkeypatch.setattr(records, "settled", lambda df: made.append(df) or df)
    dump = spark.createDataFrame([("image/png", "a", (["a", "b"],)), ("image/png", None, None), ("text/html", "a", None)],
                                 "content_type string, obj_parent string, crawl_data struct<inlinks: array<string>>")
    times = spark.createDataFrame([("a", "5")], "url string, timestamp string")
    relinked = records.relink_images(dump, times)
    assert len(made) == 1 and re.search(r"unhex\(sha2\(.*\) AS link_key", plan_of(relinked))
    known, unknown = (hashlib.sha256(text).hexdigest().upper() for text in (b"a-5", b"b-null"))
    assert {(row.obj_parent, row.crawl_data and tuple(row.crawl_data.inlinks)) for row in relinked.collect()} == {
        (known, tuple(sorted([known, unknown]))), (None, None)}
