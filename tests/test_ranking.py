"""Global ranks against a sort in one place, and files whose order is the ranking."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlspark.operators.ranking import range_borders, with_ranks
from crawlspark.operators.relevance import ranked
from crawlspark.sources.writers import write_host_report

SCHEMA = "host string, score double, rank_range int"


@pytest.fixture(scope="module")
def scores(spark):
    dice = random.Random(4)
    # A third of all rows share one score; some rows are equal in score and name.
    rows = [(f"h{dice.randrange(900)}", 0.0 if n % 3 == 0 else round(dice.random(), 2), n) for n in range(3000)]
    rows += [(None, 0.5, 1), ("x", None, 2), (None, None, 3), ("y", 0.5 + 1e-14, 4), ("z", 0.5, 5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


@pytest.mark.parametrize("ranges", [1, 8, 50, None])
def test_ranks_equal_one_sort(scores, ranges):
    found = with_ranks(scores, "host", ranges)
    assert found.columns == [*scores.columns, "rank"]
    rows = sorted(found.collect(), key=lambda row: row["rank"])
    assert [row["rank"] for row in rows] == list(range(1, 3006))
    key = lambda row: (-round(row.score, 10) if row.score is not None else float("inf"), row.host or "")
    assert [key(row) for row in rows] == sorted(key(row) for row in scores.collect())


def test_ranges_divide_rows_of_one_score(scores):
    keyed = scores.withColumn("rank_score", F.round(F.coalesce("score", F.lit(float("-inf"))), 10))
    borders = range_borders(keyed, "host", 10)
    assert len(borders) == 9 and sum(score == 0.0 for score, _ in borders) >= 2


def test_empty_table_has_no_ranks(spark):
    assert with_ranks(spark.createDataFrame([], SCHEMA), "host").collect() == []


def test_the_host_report_is_in_rank_order(spark, scores, tmp_path):
    distinct = scores.where("host is not null and score is not null").groupBy("host").agg(F.max("score").alias("score"))
    write_host_report(ranked(distinct, "host"), f"{tmp_path}/report")
    lines = [line.split(" - ")[0] for file in sorted(Path(f"{tmp_path}/report").glob("part-*")) for line in file.read_text().splitlines()]
    assert lines == [row.host for row in sorted(with_ranks(distinct, "host").collect(), key=lambda row: row["rank"])]
