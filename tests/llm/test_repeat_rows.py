"""Repeats among rows that share a doc_id, copies of one row, and passages across the seams of pieces."""

import hashlib

import numpy as np
import pytest

from crawlspark.llm import recompression, suffixes


def text_of(seed, words):
    return " ".join(f"w{n}" for n in np.random.default_rng(seed).integers(0, 10**6, words))


SHARED, SHORT = text_of(1, 90), "short"
ROWS = [(7, text_of(2, 40) + " " + SHARED), (7, SHORT), (7, text_of(3, 400)), (8, SHARED + " " + text_of(4, 30)), (3, SHARED[:-3]),
        (9, text_of(5, 70)), (9, text_of(5, 70)), (9, text_of(5, 70)), (9, text_of(6, 70)), (None, SHARED), (10, None), (10, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(4)


def expected_bytes(rows, width=400):
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows if doc_id is not None]
    count = {}
    for _, data in texts:
        for start in range(len(data) - width + 1):
            count[data[start:start + width]] = count.get(data[start:start + width], 0) + 1
    found = []
    for doc_id, data in texts:
        gone = np.zeros(len(data), bool)
        for start in range(len(data) - width + 1):
            if count[data[start:start + width]] > 1:
                gone[start:start + width] = True
        found.append((doc_id, len(data), int(gone.sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(found)


def expected_words(rows, width=50):
    texts = [(doc_id, (text or "").split()) for doc_id, text in rows if doc_id is not None]
    first = {}
    for doc_id, words in texts:
        for start in range(len(words) - width + 1):
            window = tuple(words[start:start + width])
            first[window] = min(first.get(window, doc_id), doc_id)
    found = []
    for doc_id, words in texts:
        gone = np.zeros(len(words), bool)
        for start in range(len(words) - width + 1):
            if first[tuple(words[start:start + width])] < doc_id:
                gone[start:start + width] = True
        kept = " ".join(word for word, out in zip(words, gone) if not out)
        found.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found)


def test_rows_that_share_an_id_are_texts_of_their_own(docs):
    found = suffixes.remove_repeats(docs).where("doc_id is not null").select("doc_id", "n_bytes", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == expected_bytes(ROWS)
    found = recompression.remove_later(docs).where("doc_id is not null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == expected_words(ROWS)


def test_passages_across_the_seams_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    monkeypatch.setattr(recompression, "PIECE", 90)
    rows = [(n, " ".join(text_of(20 + n, 130 + 17 * n) + " " + SHARED for _ in range(2))) for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == expected_bytes(rows)
    found = recompression.remove_later(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == expected_words(rows)


def test_planted_passages_over_many_files(spark, tmp_path):
    """60 shared words go where they make 400 bytes, and stay where they do not; `n_removed` tells which, `n_bytes` does not."""
    brief = " ".join(f"w{n}" for n in np.random.default_rng(40).integers(10, 100, 60))
    long = text_of(41, 60)
    assert len(brief) < 400 <= len(long)
    rows = [(n, " ".join([text_of(100 + n, 60 + n), ("", brief, long)[n % 3], text_of(200 + n, 40)])) for n in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(20).write.parquet(str(tmp_path / "documents"))
    found = suffixes.remove_repeats(spark.read.parquet(str(tmp_path / "documents"))).select("doc_id", "n_bytes", "n_removed", "kept_sha256")
    found = sorted(map(tuple, found.collect()))
    assert found == expected_bytes(rows)
    assert [n_removed > 0 for _, _, n_removed, _ in found] == [n % 3 == 2 for n in range(60)]
    assert [n_bytes for _, n_bytes, _, _ in found] == [len(text) for _, text in rows]
