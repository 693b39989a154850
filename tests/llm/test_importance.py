"""Importance resampling against a plain Python version, on small tables with nulls, ties, repeated rows and odd columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from crawlspark.llm import importance

WORD = re.compile("[0-9a-z\u0080-\U0010ffff]+")
LOWER = {code: code + 32 for code in range(65, 91)}
DOCS = "doc_id bigint, text string, score string, rank int, segment string, weight int"


def lines(seed, count):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{n}" for n in rng.integers(0, 60, count))


TEXTS = [None, "", " \n\t", "ONE", "Été_été-ÉTÉ 12a", lines(1, 19), lines(2, 20), lines(2, 20), "x" * 5000 + " y" * 30,
         "ß" * 200 + " " + lines(3, 40), lines(4, 30_000), "a  b\t" * 40] + [lines(n, 15 + n % 20) for n in range(5, 150)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, text, "x", n, None, n) for n, text in enumerate(TEXTS)]
    rows += [rows[9], rows[9], (None, lines(2, 50), None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def target(spark):
    rows = [(1, lines(900, 400)), (2, None), (3, "w1 W1 w2 ÉTÉ")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def grams(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[start:start + width]) for width in range(1, longest + 1)
            for start in range(len(words) - width + 1)], len(words)


def expected(rows, target, longest, buckets, seed, percent):
    bucket = lambda gram: zlib.crc32(gram.encode()) % buckets
    s = Counter(bucket(gram) for row in rows for gram in grams(row.text, longest)[0])
    t = Counter(bucket(gram) for row in target for gram in grams(row.text, longest)[0])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    found = []
    for row in rows:
        found_grams, n_words = grams(row.text, longest)
        weight = sum(gain[bucket(gram)] for gram in found_grams)
        h = int(hashlib.sha256(f"{seed}:{'' if row.doc_id is None else row.doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([row.doc_id, len(found_grams), weight, score, None, n_words])
    eligible = sorted((row for row in found if row[5] >= 20), key=lambda row: (-row[3], row[0] is None, row[0]))
    for rank, row in enumerate(eligible[:percent * len(eligible) // 100], 1):
        row[4] = rank
    return Counter(tuple(row[:5]) for row in found)


@pytest.mark.parametrize("longest, buckets, seed, percent, samples", [
    (1, 10_000, 2024, 10, 256), (3, 97, 7, 60, 2), (2, 50, 1, 100, 1)])
def test_equal_to_a_plain_version(docs, target, longest, buckets, seed, percent, samples):
    found = importance.resample(docs, target, longest, buckets, seed, percent, samples=samples)
    assert Counter(tuple(row) for row in found.collect()) == expected(
        docs.collect(), target.collect(), longest, buckets, seed, percent)


def test_equal_scores_are_split_over_segments_and_ranked_once_each(spark):
    rows = spark.range(0, 6000, 1, 6).selectExpr("if(id % 3 = 0, null, id div 1000) as doc_id", "5L as score", "id as own")
    found = importance.ranked(rows, lambda count: count // 2, 7, samples=16).collect()
    drawn = sorted((row.rank, row.doc_id) for row in found if row["rank"] is not None)
    assert len(found) == 6000 and len({row.own for row in found}) == 6000
    assert [rank for rank, _ in drawn] == list(range(1, 3001))
    assert [doc_id for _, doc_id in drawn] == sorted(row.doc_id for row in rows.collect() if row.doc_id is not None)[:3000]


def test_segments_hold_about_equal_shares(spark):
    samples = [(5, 1, place, 10.0) for place in range(100)] + [(9, 2, place, 10.0) for place in range(300)]
    cuts = importance._splitters(samples, 8)
    assert len(cuts) == 7 and [tuple(cut[:2]) for cut in cuts] == [(9, 2)] * 6 + [(5, 1)]


def test_empty_tables(spark, docs, target):
    nothing = spark.createDataFrame([], DOCS)
    assert importance.resample(nothing, target).collect() == []
    assert len(importance.resample(docs, nothing).collect()) == docs.count()


def test_drawn_documents_keep_their_columns(docs, target):
    drawn = importance.drawn_documents(docs, target, percent=50)
    ids = {row.doc_id for row in importance.resample(docs, target, percent=50).collect() if row["rank"] is not None}
    assert drawn.columns == docs.columns and {row.doc_id for row in drawn.collect()} == ids - {None}
