"""Suffix-array deduplication of byte strings, over a thinned suffix array.

Every byte covered by a `width`-byte string that also starts anywhere else goes. A suffix
array of all suffixes would move each byte of text some forty times, so only suffixes at
anchors are sorted: of the `GRAM`-byte grams in a window, the leftmost with the least
fingerprint. Equal windows have equal anchors, and an anchor's windows lie together, so
nothing is lost (see `repeats`). The anchor suffixes, led by their first bytes, are range-
partitioned by sampled splitters, sorted in their bucket by multikey quicksort and compared
with their neighbours, across bucket boundaries as well. Where suffixes agree over the core
but not over the whole stretch, the stretch is cut and its parts are sorted likewise, down to
the suffixes of single windows.

Equality of strings is that of two 64-bit fingerprints of different families.

Null texts count as empty. Repeated rows are copies of each other: each has its strings
elsewhere. Texts that share a doc_id are compared and cut like any others. Rows without doc_id are neither compared nor changed. Texts are cut into
overlapping pieces of `PIECE` window starts, so any length takes bounded memory. An
empty table gives an empty result; columns other than doc_id and text are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.fingerprints import Sequence, byte_items, window_minima
from crawlspark.llm.repeats import ROW_STRETCH_SCHEMA, STRETCH_SCHEMA, decided, few_copies, merged_runs, with_keys, with_lists
from crawlspark.llm.shared import arrow_rows, bound_batches, slice_rows

GRAM = 32
PIECE = 1 << 18


def _keys(codes: np.ndarray, starts: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Four leading bytes, then 32 bits of fingerprint, as signed numbers that sort like the bytes."""
    lead = np.zeros(len(starts), np.uint64)
    for step in range(4):
        lead = (lead << np.uint64(8)) | codes[starts + step]
    return ((lead << np.uint64(32)) | (hashed >> np.uint64(32))).view(np.int64) ^ np.int64(-1 << 63)


def anchor_stretches(codes: np.ndarray, width: int, cell: int):
    """(key, full, first window, windows) arrays for the stretches of a piece of text.

    Windows of a stretch share an anchor and a range of `cell` distances to it.
    """
    windows = len(codes) - width + 1
    grams = width - GRAM + 1
    cores, contents = Sequence(byte_items(codes, 0), 0), Sequence(byte_items(codes, 1), 1)
    places = np.arange(len(codes) - GRAM + 1)
    # The place in the low bits makes the least value that of the leftmost least gram.
    low = np.uint64((1 << 20) - 1)
    ranked = (cores.hashes(places, places + GRAM) & ~low) | places.astype(np.uint64)
    anchor = (window_minima(ranked, grams) & low).astype(np.int64)
    half = (anchor - np.arange(windows)) // cell
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(half) != 0)) + 1
    first, last = np.r_[0, cut], np.r_[cut, windows] - 1
    mark, half = anchor[first], half[first]
    # Any window whose anchor lies half*cell to half*cell+cell-1 bytes in holds the core.
    start, end = mark - half * cell, mark - half * cell - cell + 1 + width
    full = contents.hashes(first, last + width) ^ (mark - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    core = cores.hashes(start, end) + half.astype(np.uint64)
    return _keys(codes, start, core), full.view(np.int64), first, last - first + 1


def _column_batch(*columns) -> pa.RecordBatch:
    schema = STRETCH_SCHEMA if len(columns) == len(STRETCH_SCHEMA) else ROW_STRETCH_SCHEMA
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], schema=schema)


def gathered(parts, least: int = 100_000):
    """Record batches from (key, full, doc_id, at) and perhaps text_key, arrays but for the ids, joined to a useful size."""
    waiting, size = [], 0
    for key, full, doc_id, at, *text_key in parts:
        waiting.append((key, full, np.full(len(key), doc_id, np.int64), at, *[np.full(len(key), own, np.int64) for own in text_key]))
        size += len(key)
        if size >= least:
            yield _column_batch(*map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        yield _column_batch(*map(np.concatenate, zip(*waiting)))


def document_rows(batches):
    """(doc_id, text as bytes, further columns) of Arrow batches."""
    for batch in batches:
        columns = [batch.column(0), batch.column(1).cast(pa.binary()), *batch.columns[2:]]
        step = slice_rows(batch)
        for start in range(0, batch.num_rows, step):
            yield from zip(*[column.slice(start, step).to_pylist() for column in columns])


def _level(width: int):
    def stretches(cell: int):
        def work(batches):
            def parts():
                # Two copies of a row are enough to show that all it holds is elsewhere.
                for doc_id, data, text_key, *lists in few_copies(document_rows(batches), 2):
                    codes = np.frombuffer(data, np.uint8)
                    if lists:
                        pieces = ((at >> 16, (at >> 16) + (at & 0xFFFF)) for at in lists[0])
                    else:
                        pieces = ((start, start + PIECE) for start in range(0, len(codes) - width + 1, PIECE))
                    for start, end in pieces:
                        key, full, first, count = anchor_stretches(codes[start:end + width - 1], width, cell)
                        yield key, full, doc_id, (first + start) << 16 | count, text_key

            yield from gathered(parts())

        return work

    return stretches


def repeated_windows(documents: DataFrame, width: int = 400) -> DataFrame:
    """`doc_id`, `text_key`, `at` of stretches whose every window also starts elsewhere; see `repeats`, also for `documents`."""
    cells = (-(-(width - GRAM + 1) // 2), 24, 1)
    return decided(documents, _level(width), cells, F.col("same"), F.col("first"))


def remove_repeats(documents: DataFrame, width: int = 400) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `removed` per row.

    `removed` lists the maximal removed runs as start:end in bytes.
    """
    bound_batches(documents.sparkSession)
    texts = with_keys(documents)

    def work(rows):
        for doc_id, data, _, cuts in rows:
            data, cuts = data or b"", cuts or []
            runs = list(zip(cuts[::2], cuts[1::2]))
            digest, place = hashlib.sha256(), 0
            for start, end in runs:
                digest.update(memoryview(data)[place:start])
                place = end
            digest.update(memoryview(data)[place:])
            yield (doc_id, len(data), sum(end - start for start, end in runs), len(runs), digest.hexdigest(),
                   ",".join(f"{start}:{end}" for start, end in runs))

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.string())])
    return with_lists(texts, merged_runs(repeated_windows(texts, width), width), "left").mapInArrow(
        arrow_rows(work, schema),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed string")
