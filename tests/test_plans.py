"""Shapes of physical plans: what is shuffled, joined and scanned, and that hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from crawlqueries import views as V
from crawlqueries.spark_queries import QUERIES
from crawlspark.operators.joins import skew_safe_join
from crawlspark.operators.links import inlink_sets
from crawlspark.operators.stats import crawl_totals, host_counts
from crawlspark.plans.dumps import linked_dump

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_all_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_statistics_scan_each_table_once_and_only_needed_columns(spark):
    plan = plan_of(crawl_totals(host_counts(V.content(spark, SF))))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    # Suppliers have no type: the optimizer sees that none of them counts and drops their scan.
    assert len(scans) == 6
    assert not any("o_totalprice" in scan or "p_retailprice" in scan for scan in scans)


def test_semi_and_anti_joins(spark):
    assert "LeftSemi" in plan_of(QUERIES["dedup_apply"](spark, SF))
    assert "LeftAnti" in plan_of(QUERIES["cdr_dump_unlinked"](spark, SF))


def test_bodies_are_not_aggregated_when_segments_are_merged(spark):
    plan = plan_of(QUERIES["segment_merge"](spark, SF))
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any(re.search(r"\bcontent#", line) for line in aggregates)


def test_term_counting_shuffles_texts_not_terms(spark):
    plan = plan_of(QUERIES["doc_term_freq"](spark, SF))
    assert plan.count("Exchange") == 1 and plan.index("HashAggregate") < plan.index("Generate") < plan.index("Exchange")


def test_page_bodies_are_shuffled_once_in_the_index_dump(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["index_dump"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # State and links are joined below; above them there is one join with the pages.
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_split(spark, how):
    """A third of the rows share one key and the right side comes out of an aggregate."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 12)
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        left = rows.select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
        right = rows.select(key.alias("k"), "id").groupBy("k").agg(F.max("id").alias("top"))
        joined = skew_safe_join(left, right, ["k"], how)
        assert joined.count() == 60_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_lists_are_made_for_images_only(spark):
    pages = [("http://a/i.png", "image/png"), ("http://a/p", "text/plain")]
    content = spark.createDataFrame(pages, "url string, content_type string").selectExpr("*", "'x' as content", "null as http_date")
    edges = [(url, f"http://b/{n}") for url, _ in pages for n in range(60)] + [("http://gone", "http://b/1")]
    links = spark.createDataFrame(edges, "to_url string, from_url string")
    images = content.where("content_type = 'image/png'").select("url")
    sets = {row.url: row for row in inlink_sets(links, 9, slices=4, listed=images).collect()}
    whole = {row.url: row for row in inlink_sets(links, 9, slices=4).collect()}
    assert sets["http://a/i.png"] == whole["http://a/i.png"] and len(sets["http://a/i.png"].inlinks) == 10
    for url in ("http://a/p", "http://gone"):
        assert sets[url].inlinks is None and sets[url][1::2] == whole[url][1::2]
    dump = linked_dump(content, links, V.LABELS, max_inlinks=9)
    rows = {row.url: row for row in dump.collect()}
    assert rows["http://a/p"].crawl_data is None and rows["http://a/p"].n_inlinks == 60
    assert len(rows["http://a/i.png"].crawl_data.inlinks) == 10
    # Cut before lists are made: by slice, then by whether the target is an image.
    plan = plan_of(dump)
    assert re.search(r"collect_list\(CASE WHEN wanted", plan) and re.search(r"Filter .*wanted#\d+ OR .*place#", plan)


def test_hub_edges_meet_only_after_they_are_limited(spark):
    plan = plan_of(inlink_sets(V.links(spark, SF), 5000))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # From the last to the first: by target, by target and slice. Edges become distinct within their slice.
    assert [len(re.findall(r"#", keys)) for keys in exchanges] == [1, 2]
