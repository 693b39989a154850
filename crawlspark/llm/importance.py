"""Target-distribution importance resampling: hashed features, array-scored weights, ranks by regular sampling.

Features are runs of 1 to `longest` consecutive words, hashed into `buckets`. A bucket's gain is the
floored logarithm of how much more often it occurs in the target than in the documents. A
document's weight is the sum of its features' gains, looked up in one array; Gumbel noise made
from a hash of doc_id turns the highest scores into a draw without replacement.

Ranks come from a parallel sort by regular sampling: every partition is sorted into a run, each run
gives rows at regular places, and splitters cut these into segments of about equal size. Rows per
segment are counted; only segments in which the draw lies are exchanged, sorted, and numbered from
the prefix count of earlier segments on. A segment holds at most 1/segments + 1/samples of the rows,
whatever their scores: rows with equal scores and ids are told apart by their place in the runs.

Null texts have no words, weigh 0, and are not drawn, like texts with fewer than `least_words`. Rows without
doc_id are drawn too, as if the id were empty, after all others of their score. Repeated rows are documents of their
own. An empty table gives an empty result, an empty target one without gains but for what documents hold.
Columns other than doc_id and text are not looked at. Texts are hashed whole, a batch of rows at a time.
"""

import hashlib
import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.shared import as_batch, bound_batches, kept, slice_rows
from crawlspark.operators.joins import skew_safe_join

#: Regular samples of each run, and the most rows that the choice of splitters gets from all runs.
SAMPLES, MOST_SAMPLES = 256, 200_000
LONG_WORD = 64
LAST_ID = (1 << 63) - 1

# Fixed value: the reflected polynomial of CRC-32.
CRC_POLYNOMIAL = 0xEDB88320
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(CRC_POLYNOMIAL), _CRC >> 1).astype(np.uint32)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-case texts laid end to end; no word crosses a bound."""
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of many stretches of bytes: one step per byte position, over all stretches that reach it."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for step in range(min(LONG_WORD, int(sizes[0]) if len(sizes) else 0)):
        live = int(np.searchsorted(-sizes, -step, "left"))
        state = crc[:live]
        crc[:live] = _CRC[(state ^ data[begins[:live] + step]) & 0xFF] ^ (state >> np.uint32(8))
    hashed = np.empty(len(order), np.uint32)
    hashed[order] = ~crc
    for place in np.flatnonzero(lengths > LONG_WORD).tolist():
        hashed[place] = zlib.crc32(data[starts[place]:ends[place]])
    return hashed


def features(data: np.ndarray, bounds: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: bucket and text number of every feature, and words per text."""
    data = _LOWER[data]
    starts, ends = word_spans(data, bounds)
    text = np.searchsorted(bounds, starts, "right") - 1
    n_words = np.bincount(text, minlength=len(bounds) - 1)
    found, owners = [crc32_of(data, starts, ends)], [text]
    if longest > 1 and len(starts):
        # Words again, each followed by one blank, so that a run of words is one stretch.
        lengths = ends - starts
        places = np.cumsum(lengths + 1) - lengths - 1
        inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        joined = np.full(int(places[-1] + lengths[-1]) + 1, 32, np.uint8)
        joined[np.repeat(places, lengths) + inner] = data[np.repeat(starts, lengths) + inner]
        for width in range(2, longest + 1):
            whole = np.flatnonzero(text[:len(text) - width + 1] == text[width - 1:])
            last = whole + width - 1
            found.append(crc32_of(joined, places[whole], places[last] + lengths[last]))
            owners.append(text[whole])
    return np.concatenate(found).astype(np.int64) % buckets, np.concatenate(owners), n_words


def _laid_out(batches):
    """Ids, bytes and bounds of the texts of a few megabytes of rows at a time."""
    for batch in batches:
        step = slice_rows(batch)
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            texts = part.column(1).cast(pa.binary()).to_pylist()
            bounds = np.cumsum([0] + [len(text or b"") for text in texts])
            yield part.column(0).to_pylist(), np.frombuffer(b"".join(text or b"" for text in texts), np.uint8), bounds


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over a whole table; summed in tasks, one row per bucket reaches the driver."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for _, data, bounds in _laid_out(batches):
            total += np.bincount(features(data, bounds, longest, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())],
                                         names=["bucket", "n"])

    rows = texts.select(F.lit(0).alias("id"), "text").mapInArrow(count, "bucket bigint, n bigint")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold logarithm of target share over source share, both smoothed by one, per bucket."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_source + buckets) / ((s + 1) * (all_target + buckets))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Floored thousandfold Gumbel noise of a document, the same in every run."""
    named = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(named[:8], 16) + 0.5) / 4294967296)))


SCORED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64()),
                    ("score", pa.int64())])


def scored(documents: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """`doc_id`, `n_features`, `n_words`, `weight`, `score` per row."""

    def score(batches):
        for ids, data, bounds in _laid_out(batches):
            bucket, text, n_words = features(data, bounds, longest, len(gain))
            n_features = np.bincount(text, minlength=len(ids))
            weight = np.zeros(len(ids), np.int64)
            np.add.at(weight, text, gain[bucket])
            rows = zip(ids, n_features.tolist(), n_words.tolist(), weight.tolist())
            yield as_batch([(*row, row[3] + gumbel(row[0], seed)) for row in rows], SCORED)

    return documents.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        score, "doc_id bigint, n_features bigint, n_words bigint, weight bigint, score bigint")


def _splitters(samples: list[tuple], segments: int) -> np.ndarray:
    """Rows (score, key, place) that cut weighted samples into `segments` parts of about equal weight."""
    if not samples:
        return np.zeros((0, 3), np.int64)
    score, key, place, weight = (np.array(column) for column in zip(*samples))
    order = np.lexsort((place, key, -score))
    upto = np.cumsum(weight[order])
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, segments) / segments)
    cuts = order[np.unique(cuts[cuts < len(order)])]
    return np.stack([score[cuts], key[cuts], place[cuts]], axis=1).astype(np.int64)


def _segment_of(splitters: np.ndarray) -> Callable:
    """A `mapInArrow` function that adds the segment of each row: how many splitters come before it."""

    def segment(batches):
        for batch in batches:
            names = batch.schema.names
            score, key, place = (np.concatenate([splitters[:, n], batch.column(names.index(name)).to_numpy()])
                                 for n, name in enumerate(("score", "key", "place")))
            order = np.lexsort((place, key, -score))
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(order < len(splitters))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before[len(splitters):])],
                                             names=[*names, "segment"])

    return segment


def ranked(rows: DataFrame, draw: Callable[[int], int], segments: int, samples: int = SAMPLES) -> DataFrame:
    """`rows` (`doc_id`, `score` and others) with `rank`, 1 for the highest score, for the first `draw(count)` rows.

    Ties go to the smaller doc_id. Only rows of segments that the draw reaches are shuffled.
    """
    keyed = rows.withColumn("key", F.coalesce("doc_id", F.lit(LAST_ID)))
    runs = kept(keyed.sortWithinPartitions(F.desc("score"), "key").withColumn("place", F.monotonically_increasing_id()))
    spark, run = rows.sparkSession, F.shiftright("place", 33)
    lengths = runs.groupBy(run.alias("run")).count().withColumnRenamed("count", "length").collect()
    total = sum(row.length for row in lengths)
    each = max(1, min(samples, MOST_SAMPLES // max(1, len(lengths))))
    known = F.broadcast(spark.createDataFrame([tuple(row) for row in lengths], "run bigint, length bigint"))
    within = "(place & 8589934591)"
    regular = runs.withColumn("run", run).join(known, "run").where(
        f"(({within} + 1) * {each}) div length > ({within} * {each}) div length")
    cuts = _splitters([tuple(row) for row in regular.select(
        "score", "key", "place", F.col("length") / F.least("length", F.lit(each))).collect()], segments)
    placed = runs.mapInArrow(_segment_of(cuts), runs.withColumn("segment", F.lit(0).cast("bigint")).schema)
    sizes = sorted(tuple(row) for row in placed.groupBy("segment").count().collect())
    drawn, offsets, before = draw(total), [], 0
    for segment, size in sizes:
        if before < drawn:
            offsets.append((segment, before))
        before += size
    last = offsets[-1][0] if offsets else -1
    within = Window.partitionBy("segment").orderBy(F.desc("score"), "key", "place")
    place = F.row_number().over(within) + F.col("before")
    offset = F.broadcast(spark.createDataFrame(offsets, "segment bigint, before bigint"))
    reached = placed.where(F.col("segment") <= last).join(offset, "segment").withColumn("rank", place)
    names = rows.columns
    return reached.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).union(
        placed.where(F.col("segment") > last).select(*names, F.lit(None).cast("bigint").alias("rank")))


def resample(documents: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
             percent: int = 10, least_words: int = 20, samples: int = SAMPLES) -> DataFrame:
    """`doc_id`, `n_features`, `weight`, `score`, `rank` of all rows; `percent` of those with `least_words` are drawn."""
    spark = documents.sparkSession
    bound_batches(spark)
    gain = gains(bucket_counts(documents, longest, buckets), bucket_counts(target, longest, buckets))
    rows = kept(scored(documents, gain, longest, seed))
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    eligible = ranked(rows.where(F.col("n_words") >= least_words), lambda count: percent * count // 100, segments, samples)
    others = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return eligible.union(others).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(documents: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of `documents` whose doc_id was drawn; rows that share it come together, rows without one stay out."""
    drawn = resample(documents, target, **settings).where("rank is not null and doc_id is not null")
    return skew_safe_join(documents, drawn.select("doc_id").distinct(), ["doc_id"], "left_semi").select(*documents.columns)
