"""The operators' queries against their SQL, and the pipeline's stages against brute force, on whole tables."""

import re

import numpy as np
import pytest

import corpus_pipeline
from compare import difference, open_tables
from crawlspark.llm import decontam, pii, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {code: code + 32 for code in range(65, 91)}


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, tables, name):
    assert difference(queries.QUERIES[name], queries.ORACLE_SQL[name], spark, tables, SF) == ""


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's result, each made from its predecessor's."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        results[name] = result.collect()
        docs = spark.createDataFrame(results[name], result.schema)
    return results


def kept_near_duplicates(rows):
    sets = {}
    for row in rows:
        words = WORD.findall((row.text or "").translate(LOWER))
        sets[row.doc_id] = {tuple(words[start:start + 5]) for start in range(max(1, len(words) - 4))} if words else set()
    component = {doc_id: doc_id for doc_id in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((component[a], component[b]))
                component = {doc_id: low if own == high else own for doc_id, own in component.items()}
    return {doc_id for doc_id, own in component.items() if doc_id == own}


def folded(text):
    low = {**LOWER, **{code: code + 32 for code in range(0xC0, 0xDF) if code != 0xD7}}
    return np.array(re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(low)), dtype=object)


def overlaps(words, item):
    if len(item) < decontam.LEAST:
        return len(item) > 0 and any((words[start:start + len(item)] != item).sum() <= (len(item) >= 8)
                                     for start in range(len(words) - len(item) + 1))
    rows, columns = len(item) - decontam.LEAST + 1, len(words) - decontam.LEAST + 1
    if columns <= 0:
        return False
    same, agree = item[:, None] == words[None, :], np.zeros((rows, columns), np.int8)
    for step in range(decontam.LEAST):
        agree += same[step:step + rows, step:step + columns]
    return bool((agree >= decontam.LEAST - decontam.ERRORS).any())


def test_near_duplicates_of_the_pipeline(stages):
    left = {row.doc_id for row in stages["near_duplicates"]}
    assert left == kept_near_duplicates(stages["language"]) and len(left) < len(stages["language"])


def test_decontamination_of_the_pipeline(spark, stages):
    numbers = {}
    number = lambda words: np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    items = [number(folded(row.text)) for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = {row.doc_id for row in stages["near_duplicates"]
                if not any(overlaps(words, item) for words in [number(folded(row.text))] for item in items)}
    left = {row.doc_id for row in stages["decontamination"]}
    assert left == expected and len(left) < len(stages["near_duplicates"])


def test_only_personal_data_is_changed(spark, stages):
    before = {row.doc_id: row for row in stages["decontamination"]}
    docs = spark.createDataFrame(stages["decontamination"])
    spans = {row.doc_id: row.spans for row in pii.find_personal_data(docs).collect()}
    assert len(stages["personal_data"]) == len(before)
    for row in stages["personal_data"]:
        assert (row.text != before[row.doc_id].text) == (spans[row.doc_id] != "")
        assert row[2:4] == before[row.doc_id][2:4]


def test_mixture_of_the_pipeline(stages):
    sizes = {row.doc_id: len(WORD.findall(row.text or "")) for row in stages["personal_data"]}
    used = {row.doc_id: row.repeats for row in stages["mixture"]}
    taken, budget = sum(sizes[doc_id] * n for doc_id, n in used.items()), 1.5 * sum(sizes.values())
    assert set(used.values()) <= {1, 2} and budget - max(sizes.values()) < taken <= budget
