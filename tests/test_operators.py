"""Operators on small fixtures, against hand-made or brute-force results."""

import hashlib
import json
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import dedup, joins, links, metadata, records, relevance, stats
from crawlspark.plans import dumps
from crawlspark.plans import relevance as relevance_plans
from crawlspark.sources.writers import index_json


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest().upper()


LABELS = records.RunLabels("webpage", "c", "t")
CONTENT = "segment string, url string, content_type string, content string, http_date string"
DATE = "Tue, 30 Aug 2016 18:00:00 GMT"


@pytest.fixture(scope="module")
def content(spark):
    page = "<html><title>T</title><body>" + "word " * 40 + "<a href='/b'>b</a></body></html>"
    return spark.createDataFrame([
        ("s1", "http://h/a", "text/html", page, DATE),
        ("s1", "http://h/i.png", "image/png", "bytes", DATE),
        ("s1", "http://h/b", "text/html", "", DATE),
        ("s1", "http://h/n", None, page, None),
        ("s2", "http://h/a", "text/html", page, "bad"),
        ("s2", "http://h/p", "application/pdf", "x" * 149, None),
    ], CONTENT)


def test_inlink_limit(spark):
    few = [("http://t/few", f"http://f/{i:05d}") for i in range(5001)]
    many = [("http://t/many", f"http://f/{i:05d}") for i in range(5002)]
    extra = [("http://t/many", "http://f/00000")] * 10 + [("http://t/self", "http://t/self"), ("http://t/c", "a,b"),
                                                         (None, "x"), ("x", None)]
    edges = spark.createDataFrame(few + many + extra, "to_url string, from_url string")
    rows = {row.url: row for row in links.inlink_sets(edges, 5000, slices=7).collect()}
    assert set(rows) == {"http://t/few", "http://t/many", "http://t/self", "http://t/c"}
    assert [len(rows[f"http://t/{name}"].inlinks) for name in ("few", "many", "self")] == [5001, 5001, 1]
    assert rows["http://t/many"].inlinks == [source for _, source in many[:5001]]
    assert rows["http://t/many"].parent == "http://f/00000"
    assert rows["http://t/c"].inlinks == ["a,b"]


def test_linked_and_unlinked_split_the_urls(spark, content):
    edges = spark.createDataFrame([("http://h/i.png", "http://h/a"), ("http://h/a", "http://h/b"),
                                   ("http://h/a", "http://h/b")], "to_url string, from_url string")
    linked = dumps.linked_dump(content, edges, LABELS, max_inlinks=5000).collect()
    assert Counter(row.url for row in linked) == {"http://h/a": 2, "http://h/i.png": 1}
    image = next(row for row in linked if row.url.endswith("png"))
    assert image.obj_parent == "http://h/a" and image.crawl_data.inlinks == ["http://h/a"]
    assert all(row.crawl_data is None and row.obj_parent is None for row in linked if row is not image)
    assert image._id == sha("http://h/i.png-1472580000000") and image.extracted_metadata == {}
    left = dumps.linked_dump(content, edges, LABELS, how="left", expanded=True, max_inlinks=5000).collect()
    assert Counter(row.url for row in left) == {"http://h/a": 2, "http://h/i.png": 1, "http://h/p": 1}
    assert {row.host for row in left} == {"h"}
    assert sum(row.crawl_data is not None for row in left) == 3
    unlinked = dumps.unlinked_dump(content, edges, LABELS)
    assert unlinked.count() == 0  # the empty page, the untyped page and the short file are no pages


def test_statistics(content):
    counts = stats.host_counts(content)
    assert [tuple(row) for row in counts.collect()] == [("h", 3)]
    assert stats.crawl_totals(counts).first() == (1, 3)


def test_dedup(spark):
    rows = [("file:///d/part-00000", "1", "u", "x"), ("file:///d/part-00001", "2", "u", "x"),
            ("file:///d/part-00001", "3", "u", "y"), ("file:///d/part-00000", "1", "u", "x"),
            ("file:///d/part-00000", "4", "v", "x"), ("file:///d/part-00001", "4", "w", "z")]
    dump = spark.createDataFrame(rows, "path string, _id string, url string, raw_content string")
    index = dedup.dedup_index(dump)
    assert {(row.path, row.doc_id) for row in index.collect()} == {
        ("/d/part-00000", "1"), ("/d/part-00001", "3"), ("/d/part-00000", "4"), ("/d/part-00001", "4")}
    kept = dedup.apply_dedup_index(dump, index)
    assert sorted(row._id for row in kept.collect()) == ["1", "1", "3", "4", "4"]
    exact = dedup.apply_dedup_index(dump, index, exact=True)
    assert sorted(row._id for row in exact.collect()) == ["1", "3", "4", "4"]
    # A dump read through another spelling of its path still matches, and a second pass changes nothing.
    moved = dump.withColumn("path", F.replace("path", F.lit("file:///d"), F.lit("file:/d")))
    assert dedup.apply_dedup_index(moved, index).count() == 5
    again = dedup.apply_dedup_index(exact, dedup.dedup_index(exact), exact=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, exact.collect()))


def test_merge_and_first_text(spark):
    rows = [("s1", "u", "text/plain", "old", 1), ("s2", "u", "text/plain", "new", 2), ("s1", "v", None, None, None)]
    df = spark.createDataFrame(rows, "segment string, url string, content_type string, content string, t int")
    merged = dedup.merge_segments(df, F.col("t")).collect()
    assert {(row.url, row.content) for row in merged} == {("u", "new"), ("v", None)}
    # Copies in any number, records without URL, and ties by segment, type, date and body each leave one row.
    more = df.union(df).union(df.selectExpr("segment", "null", "content_type", "content", "t")).union(
        df.where("t = 2").selectExpr("'s3'", "url", "content_type", "'newer segment'", "t"))
    again = dedup.merge_segments(more.union(more), F.col("t")).collect()
    assert len(again) == 3
    assert {(row.url, row.content) for row in again} == {(None, "new"), ("u", "newer segment"), ("v", None)}
    assert dedup.merge_segments(df.limit(0), F.col("t")).collect() == []
    texts = df.select("segment", "url", F.col("content").alias("text")).where("text is not null")
    assert [tuple(row) for row in dedup.one_text_per_url(texts).collect()] == [("u", "old")]


def test_relinked_images(spark):
    schema = "_id string, content_type string, obj_parent string, crawl_data struct<inlinks:array<string>>"
    dump = spark.createDataFrame([
        ("1", "image/png", "p", (["p", "q", "a,b"],)), ("2", "image/png", None, None),
        ("3", "text/html", "p", (["p"],)), ("4", "image/png", "gone", (["gone"],)),
        ("1", "image/png", "p", (["p", "q", "a,b"],))], schema)
    times = spark.createDataFrame([("p", "5"), ("q", None)], "url string, timestamp string")
    rows = sorted(records.relink_images(dump, times).collect(), key=lambda row: row._id)
    assert [row._id for row in rows] == ["1", "1", "2", "4"]
    assert rows[0] == rows[1] and rows[0].obj_parent == sha("p-5")
    assert rows[0].crawl_data.inlinks == sorted([sha("p-5"), sha("q-null"), sha("a,b-null")])
    assert rows[2].obj_parent is None and rows[2].crawl_data is None
    assert rows[3].obj_parent == sha("gone-null")


def test_colliding_metadata_names(spark):
    page = '<html><meta name="B c" content="2"><meta name="BC" content="1"><meta name="n" content="1"><meta name="n" content="x">'
    df = spark.createDataFrame([("s", "u", "text/html", page, None)], CONTENT)
    fields = {row.field: (row.name, row["values"]) for row in metadata.typed_metadata(df).collect()}
    assert fields == {"bc_l_md": ("B c", ["2"]), "n_ls_md": ("n", ["1"])}
    catalogue = {row.field: (row.n_values, row.n_names) for row in metadata.field_catalogue(df).collect()}
    assert catalogue == {"bc_l_md": (2, 2), "n_ls_md": (1, 1)}


def test_field_catalogue_counts_pages_and_typed_values(spark):
    one = ('<html><meta name="B c" content="2"><meta name="BC" content="1"><meta name="n" content="1"><meta name="n" content="x">'
           '<meta name="n" content="7">')
    two = '<html><meta name="bc" content="5"><meta name="id" content="3"><meta name="ID" content="x">'
    df = spark.createDataFrame([("s", "u", "text/html", one, None), ("s", "v", "text/html", two, None), ("s", "w", "image/png", two, None)],
                               CONTENT)
    catalogue = {row.field: (row.kind, row.n_pages, row.n_values, row.n_names, row.first_name, row.names)
                 for row in metadata.field_catalogue(df).collect()}
    assert catalogue == {"bc_l_md": ("long", 2, 3, 3, "B c", ["B c", "BC", "bc"]), "n_ls_md": ("long", 1, 2, 1, "n", ["n"]),
                         "id_md": ("long", 1, 1, 1, "id", ["id"]), "id_t_md": ("text", 1, 1, 1, "ID", ["ID"])}


def test_index_records_as_flat_json(spark, content):
    page = ('<html><title>A "t"</title><meta name="size" content="3"><meta name="k" content="true">'
            '<meta name="k" content="false"><meta name="id" content="x"><a href="b">b</a>')
    pages = content.unionByName(spark.createDataFrame([("s1", "http://h/x", "text/html", page, DATE)], CONTENT))
    state = spark.createDataFrame(
        [("http://h/x", "db_fetched", 1472580000000, 0.5, 90000, 2, {"pst": "a=1000", "nutch.protocol.code": "200"}),
         ("http://h/i.png", "db_gone", 5, 0.0, 0, 0, None)],
        "url string, status string, fetch_time bigint, score double, fetch_interval int, retries int, "
        "metadata map<string,string>")
    edges = spark.createDataFrame([("http://h/i.png", "http://h/a")], "to_url string, from_url string")
    index = dumps.index_dump(pages, state, edges, "run", "c", indexed_at=F.lit(0).cast("bigint"), max_inlinks=5000)
    docs = {doc["url"]: doc for doc in (json.loads(row.line) for row in index.select(
        index_json(index).alias("line")).collect())}
    assert set(docs) == {"http://h/x", "http://h/i.png"}
    doc = docs["http://h/x"]
    assert doc["id"] == sha("http://h/x-run-1472580000000") and doc["outlinks"] == ["http://h/b"]
    assert doc["title_t_md"] == 'A "t"' and doc["size_l_md"] == 3 and doc["k_bs_md"] == [True, False]
    assert doc["id_md"] == "x" and doc["modified_time"] == "1970-01-01T00:00:01Z" and doc["retry_interval_days"] == 1
    assert doc["status_name"] == "FETCHED" and doc["status_code"] == "200" and doc["indexed_at"] == "1970-01-01T00:00:00Z"
    image = docs["http://h/i.png"]
    assert image["inlinks"] == ["http://h/a"] and "raw_content" not in image and "outlinks" not in image
    assert "status_name" not in image and image["signature"] == sha("bytes")
    left = dumps.index_dump(pages, state.where("url = 'http://h/x'"), edges, "run", "c", how="left", max_inlinks=5000)
    kept = {row.url: row for row in left.collect()}
    assert set(kept) == {"http://h/x", "http://h/a", "http://h/i.png", "http://h/p"}
    assert kept["http://h/i.png"].id == sha("http://h/i.png-run-null")
    assert kept["http://h/i.png"].inlinks == ["http://h/a"] and kept["http://h/p"].inlinks is None


def test_lookup_join_beyond_the_bound(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a", "x" * 100)], "k string, w string")
    assert joins.table_bytes(right) > 100
    for bound in (10, 10_000):
        rows = joins.lookup_join(left, right, ["k"], broadcast_bytes=bound).collect()
        assert sorted((row.k, row.w is None) for row in rows) == [("a", False), ("b", True)]


def test_hot_groups_stay_whole(spark):
    """One url, body, host and link target own a third of all rows; nothing is dropped."""
    n = 3000
    i = F.col("id")
    hot = i % 3 == 0
    url = F.when(hot, "http://hot/x").otherwise(F.concat(F.lit("http://h"), (i % 7).cast("string"), F.lit("/"), i))
    pages = spark.range(n).select(
        F.lit("s").alias("segment"), url.alias("url"), F.lit("text/plain").alias("content_type"),
        F.when(hot, F.lit("same " * 40)).otherwise(F.concat(F.lit("word " * 40), i.cast("string"))).alias("content"),
        F.lit(None).cast("string").alias("http_date"))
    edges = spark.range(n).select(F.when(hot, "http://hot/x").otherwise(url).alias("to_url"),
                                  F.concat(F.lit("http://f/"), F.lpad(i.cast("string"), 5, "0")).alias("from_url"))
    linked = dumps.linked_dump(pages, edges, LABELS, max_inlinks=5000)
    assert linked.count() == n and linked.where("url = 'http://hot/x'").count() == n // 3
    sets = {row.url: len(row.inlinks) for row in inlink_sets_of(edges, 99)}
    assert sets["http://hot/x"] == 100 and sum(sets.values()) == 100 + n * 2 // 3
    counts = {row.host: row.n_urls for row in stats.host_counts(pages).collect()}
    assert counts["hot"] == 1 and sum(counts.values()) == 1 + n * 2 // 3
    kb = spark.createDataFrame([("k", "same thing"), ("l", "other")], "kb_url string, kb_text string")
    none = spark.createDataFrame([], "word string")
    scores = relevance.page_relevance(pages, kb, none)
    assert scores.count() == n and scores.where("score > 0").count() == n // 3


def test_preview_is_the_first_rows_in_order(spark):
    rows = spark.createDataFrame([(n % 7, f"r{n:02d}") for n in range(40)], "a int, b string").repartition(5)
    assert [row.b for row in stats.preview(rows, "a", "b", n=7).collect()] == ["r00", "r07", "r14", "r21", "r28", "r35", "r01"]
    assert [tuple(row) for row in stats.preview(rows, n=1).collect()] == [(0, "r00")]
    assert stats.preview(rows).count() == 20 and stats.preview(rows.limit(0)).collect() == []
    plan = stats.preview(rows, "b")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def inlink_sets_of(edges, limit):
    return links.inlink_sets(edges, max_inlinks=limit).collect()


# --- relevance against plain Python ---

KB = [("k1", "Apple pie the apple"), ("k2", "pear the Tree"), ("k3", ""), ("k2", "apple tart the"),
      ("k4", "pear the Tree")]
DOCS = [("http://www.a.org/1", "apple pear Tree of the"), ("http://www.a.org/2", "Apple apple unknown"),
        ("http://b.org/1", "nothing here"), ("http://b.org/2", "")]
STOP = ["the", "Of"]


def cosine(left: dict, right: dict) -> float:
    dot = sum(value * right.get(term, 0.0) for term, value in left.items())
    norm = math.sqrt(sum(v * v for v in left.values())) * math.sqrt(sum(v * v for v in right.values()))
    return dot / norm if dot else 0.0


def expected_relevance():
    stop = {word.lower() for word in STOP}
    bags = [(url, [term for term in text.lower().split() if term not in stop]) for url, text in KB]
    tf = Counter(term for _, bag in bags for term in bag)
    df = Counter(term for term, _ in {(term, url) for url, bag in bags for term in bag})
    profile = {term: tf[term] * math.log(len(KB) / df[term]) for term in tf}
    return {url: cosine(Counter(text.lower().split()), profile) for url, text in DOCS}


def smoothed_vectors():
    bags = [Counter(text.split()) for _, text in KB]
    df = Counter(term for bag in bags for term in bag)
    idf = {term: math.log((len(KB) + 1) / (df[term] + 1)) for term in df}
    unseen = math.log(len(KB) + 1)
    kb = [{term: n * idf[term] for term, n in bag.items()} for bag in bags]
    docs = {url: {term: n * idf.get(term, unseen) for term, n in Counter(text.split()).items()} for url, text in DOCS}
    return kb, docs


@pytest.fixture(scope="module")
def kb(spark):
    return spark.createDataFrame(KB, "kb_url string, kb_text string")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [("s", url, "text/plain", text, None) for url, text in DOCS]
    return spark.createDataFrame(rows, CONTENT)


def test_page_relevance(spark, kb, pages):
    words = spark.createDataFrame([(word,) for word in STOP], "word string")
    expected = expected_relevance()
    doubled = pages.unionByName(pages)
    rows = relevance.page_relevance(doubled, kb, words).collect()
    assert len(rows) == 2 * len(DOCS)
    for row in rows:
        assert row.score == pytest.approx(expected[row.url], abs=1e-12)
    assert {row.host for row in rows} == {"a.org", "b.org"}
    # Every knowledge-base row again under a new url: the weights double, the scores stay.
    twice = kb.unionByName(kb.withColumn("kb_url", F.concat("kb_url", F.lit("x")))).repartition(3)
    for row in relevance.page_relevance(pages, twice, words).collect():
        assert row.score == pytest.approx(expected[row.url], abs=1e-12)


@pytest.mark.parametrize("num_features", [None, 1 << 20])
def test_mean_similarity_equals_all_pairs(kb, pages, num_features):
    vectors, docs = smoothed_vectors()
    expected = {url: sum(cosine(doc, vector) for vector in vectors) / len(vectors) for url, doc in docs.items()}
    scores = relevance_plans.url_similarity(pages, kb, num_features)
    found = {row.url: row.score for row in scores.collect()}
    assert found == pytest.approx(expected, abs=1e-12)
    hosts = [(row.host, row.score) for row in relevance_plans.host_similarity(pages, kb, num_features).collect()]
    assert [host for host, _ in hosts] == ["a.org", "b.org"]
    assert hosts[0][1] == pytest.approx(sum(v for u, v in expected.items() if "www.a.org" in u) / 2, abs=1e-12)
    assert [row.url for row in relevance.top(scores, "url", 2).collect()] == sorted(
        expected, key=lambda url: (-expected[url], url))[:2]
    assert [row.url for row in relevance.bottom(scores, "url", 1).collect()] == ["http://b.org/2"]


def test_scores_are_the_same_with_a_checkpoint_folder(spark, kb, pages, tmp_path):
    words = spark.createDataFrame([(word,) for word in STOP], "word string")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(str(tmp_path))
    expected = expected_relevance()
    for row in relevance.page_relevance(pages, kb, words).collect():
        assert row.score == pytest.approx(expected[row.url], abs=1e-12)


def test_pooled_similarity(kb, pages):
    vectors, docs = smoothed_vectors()
    pooled = Counter()
    for vector in vectors:
        pooled.update(vector)
    expected = {url: cosine(doc, pooled) for url, doc in docs.items()}
    found = {row.url: row.score for row in relevance_plans.top_domains(pages, kb).collect()}
    assert found == pytest.approx(expected, abs=1e-12)


def test_chunks_hold_every_inlink_of_a_hub(spark):
    edges = spark.range(6000).selectExpr("'http://hub/' as to_url", "concat('http://p/', id) as from_url")
    edges = edges.union(edges).union(spark.createDataFrame([("http://t/", "http://p/1"), (None, "x"), ("y", None)], "to_url string, from_url string"))
    rows = links.inlink_chunks(edges, chunk_size=500).collect()
    hub = [row for row in rows if row.url == "http://hub/"]
    assert len(hub) == 12 and {row.n_inlinks for row in hub} == {6000}
    assert sorted(link for row in hub for link in row.inlinks) == sorted(f"http://p/{i}" for i in range(6000))
    assert max(len(row.inlinks) for row in hub) < 1000
    limited = {row.url: row for row in links.inlink_sets(edges, 9).collect()}
    assert len(limited["http://hub/"].inlinks) == 10 and limited["http://hub/"].n_inlinks == 6000
