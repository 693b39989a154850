"""Families of near copies: whole clusters and bucket by bucket, rows that share an id, and the tables left behind."""

import os
import random

import numpy as np
import pytest

from crawlspark.llm import neardup, shared

SHINGLE = 4


def family(seed, count, words=60, changes=2):
    """Copies of one text, each with some words replaced: similar to the text, less to each other."""
    dice = random.Random(seed)
    base = [f"b{seed}x{n}" for n in range(words)]
    texts = []
    for copy in range(count):
        own = list(base)
        for place in dice.sample(range(words), changes):
            own[place] = f"c{dice.randrange(10**9)}"
        texts.append(" ".join(own))
    return texts


def components_of(texts, percent=80):
    sets = [set(neardup.shingle_set(text.encode(), SHINGLE).tolist()) for text in texts]
    label = np.arange(len(texts))
    for a in range(len(texts)):
        for b in range(a):
            if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label[label == high] = low
    return dict(enumerate(label.tolist()))


@pytest.fixture(scope="module")
def texts():
    found = family(1, 250) + family(2, 60, 200, 5) + family(3, 80, 120, 3) + family(4, 40, 300, 25)
    random.Random(1).shuffle(found)
    return found


@pytest.mark.parametrize("block, volume, dense", [(2048, 1 << 21, True), (16, 1 << 21, True), (2048, 4000, True),
                                                  (2048, 900, False), (1, 1, False)])
def test_all_ways_of_comparing_equal_all_pairs(spark, texts, monkeypatch, block, volume, dense):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "VOLUME", volume)
    used = []
    apart = neardup.apart_pairs
    monkeypatch.setattr(neardup, "apart_pairs", lambda *arguments: used.append(1) or apart(*arguments))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    found = {row.doc_id: row.component_id for row in neardup.near_duplicates(docs, SHINGLE).collect()}
    assert found == components_of(texts) and bool(used) != dense


def test_a_family_takes_little_room(spark, tmp_path, monkeypatch):
    """1,500 texts of which no two are similar enough, though all look alike."""
    docs = spark.createDataFrame(list(enumerate(family(7, 1500, 60, 5))), "doc_id bigint, text string")
    monkeypatch.setattr(shared, "scratch_folder", lambda spark: str(tmp_path))
    assert neardup.near_duplicates(docs, SHINGLE).where("kept").count() == 1500
    left = sum(os.path.getsize(os.path.join(place, name)) for place, _, names in os.walk(tmp_path) for name in names)
    assert left < 5 * sum(len(text) for text in family(7, 1500, 60, 5))


def test_texts_that_share_an_id(spark):
    one, two, three = (" ".join(f"{mark}{n}" for n in range(40)) for mark in "abc")
    rows = [(7, one, "x"), (7, two, "y"), (7, two, "y"), (8, one + " end", "z"), (9, two + " end", "z"), (10, three, "z"),
            (11, "", "e"), (11, "", "e"), (None, one, "n"), (None, None, "n"), (12, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component string").repartition(3)
    found = sorted((row.doc_id, row.component_id, row.kept) for row in neardup.near_duplicates(docs).where("doc_id in (7, 8, 9, 10)").collect())
    assert found == [(7, 7, True)] * 3 + [(8, 7, False), (9, 7, False), (10, 10, True)]
    kept = neardup.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(7, one, "x"), (7, two, "y"), (10, three, "z"), (11, "", "e"), (11, "", "e"), (None, one, "n"), (None, None, "n"),
         (12, None, "e")], key=str)


def test_superseded_tables_are_gone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "scratch_folder", lambda spark: str(tmp_path))
    table = shared.kept(spark.range(5))
    assert table.count() == 5 and len(list(tmp_path.iterdir())) == 1
    shared.superseded(table)
    assert not list(tmp_path.iterdir())


def reached(edges):
    """The smallest id that each id of `edges` reaches."""
    label = {id_: id_ for edge in edges for id_ in edge if edge[0] != edge[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


EDGES = {
    "chain": [(n * 37 % 101, (n + 1) * 37 % 101) for n in range(40)], "none": [(3, 3)],
    "hubs": [(1000, n) for n in range(60)] + [(n, -1) for n in range(90, 120)] * 2 + [(n, 2000 + n % 2) for n in range(200, 230)] + [(205, 2001)]}


@pytest.mark.parametrize("name", EDGES)
@pytest.mark.parametrize("held, broadcast", [(100_000, 1 << 25), (5, 0)])
def test_components_reach_the_smallest_id(spark, monkeypatch, name, held, broadcast):
    monkeypatch.setattr(shared, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(shared, "STAR_ROWS", held)
    edges = spark.createDataFrame(EDGES[name], "a bigint, b bigint").repartition(4)
    found = shared.components(edges).collect()
    assert {row.id: row.component for row in found} == reached(EDGES[name]) and len(found) == len(reached(EDGES[name]))


def test_a_round_of_components_takes_few_shuffles(spark, tmp_path, monkeypatch):
    """A deep tree of links: tables written, and shuffles among them, do not grow with its depth."""
    plans = []
    kept = shared.kept
    monkeypatch.setattr(shared, "kept", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    edges = spark.createDataFrame([(n, n // 2) for n in range(1, 2000)], "a bigint, b bigint").repartition(5)
    assert {row.component for row in shared.components(edges).collect()} == {0}
    assert sum(plan.count("Exchange hash") for plan in plans) <= 9
