"""Exact rank numbers over a whole table, without bringing it into one task."""

from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.operators.joins import settled
from crawlspark.operators.relevance import SCORE_DIGITS

#: Rows that the choice of range borders looks at, about; they alone reach the driver, besides one count per range.
SAMPLE_ROWS = 20_000


def range_borders(keyed: DataFrame, name: str, ranges: int, sample_rows: int = SAMPLE_ROWS) -> list[tuple[float, str]]:
    """(score, name) of the rows that end each range but the last, from rows picked by a hash of the name."""
    every = max(1, keyed.count() // sample_rows)
    picked = keyed.where(F.pmod(F.xxhash64(name), F.lit(every)) == 0).select("rank_score", name).distinct().collect()
    order = sorted({(-score, text) for score, text in picked if text is not None})
    places = sorted({len(order) * part // ranges for part in range(1, ranges)})
    return [(-order[place][0], order[place][1]) for place in places if place < len(order)]


def with_ranks(scores: DataFrame, name: str, ranges: int | None = None) -> DataFrame:
    """`scores` with `rank`: 1 for the largest score, equal scores by name, rows equal in both in any order.

    Scores are compared rounded to `SCORE_DIGITS`, like in `ranked`; a null score or name counts as the least. Rows are dealt out to
    ranges of the order, counted per range, and numbered within their range from the sum of earlier counts on. A score that many rows
    share is divided by name, so a range holds about 1/`ranges` of the rows, and more only where score and name are equal.
    """
    keyed = settled(scores).withColumn("rank_score", F.round(F.coalesce("score", F.lit(float("-inf"))), SCORE_DIGITS))
    ranges = ranges or int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = range_borders(keyed, name, ranges)
    text = F.coalesce(name, F.lit(""))
    if borders:
        array = F.array(*[F.struct(F.lit(score).alias("score"), F.lit(border).alias("name")) for score, border in borders])
        passed = F.filter(array, lambda border: (border["score"] > F.col("rank_score")) | (
            (border["score"] == F.col("rank_score")) & (border["name"] < text)))
        keyed = keyed.withColumn("rank_range", F.size(passed))
    else:
        keyed = keyed.withColumn("rank_range", F.lit(0))
    counts = {row["rank_range"]: row["count"] for row in keyed.groupBy("rank_range").count().collect()}
    places = sorted(counts)
    before = [(place, sum(counts[other] for other in places[:bisect_left(places, place)])) for place in places]
    offsets = F.broadcast(scores.sparkSession.createDataFrame(before, "rank_range int, rank_before bigint"))
    within = Window.partitionBy("rank_range").orderBy(F.desc("rank_score"), text)
    return keyed.join(offsets, "rank_range").withColumn("rank", F.row_number().over(within) + F.col("rank_before")).select(
        *scores.columns, "rank")
