"""Substring deduplication of word sequences by recompression.

Each word is removed that lies in a window of `width` words which also starts in a document
with a smaller doc_id. Texts are recompressed in rounds: runs of one symbol are named, then
pairs of a left and a right symbol, the two kinds told apart by a bit of the symbol's name.
A name is the 64-bit fingerprint of what it stands for, which is the same in every task, so
that naming is global without a shuffle per round. What is named depends on
neighbouring symbols alone; symbols never grow beyond the round's cap. Equal windows
therefore have equal symbols except within `margin(caps)` words of their ends.

A window's anchor is the symbol with the least name in that interior, the leftmost of equals. A shared
anchor with equal words all around it reveals a repeat, and `repeats` verifies it window by window.
Rounds end with symbols of four words: a further round could leave a 50-word window without
a symbol that is sure to be whole.

Equality of word sequences is that of two 64-bit fingerprints of different families.
Null texts have no words. Rows with one doc_id never remove from each other, so repeated rows keep
what one of them keeps. Rows without doc_id are neither compared nor changed. An empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.fingerprints import Sequence, mix, window_minima, word_bounds, word_items
from crawlspark.llm.repeats import decided, few_copies, merged_runs, with_keys, with_lists
from crawlspark.llm.shared import arrow_rows, bound_batches
from crawlspark.llm.suffixes import document_rows, gathered

CAPS = (2, 4)
PIECE = 1 << 17
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def margin(caps: tuple[int, ...] = CAPS) -> int:
    """Words at either end of a window within which its symbols may depend on what lies outside.

    In the run step of a round the first certain cut may move by one run, in the pair step by one symbol;
    neither is longer than the cap.
    """
    return 2 * sum(caps)


def _name_runs(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, cap: int, salt: int):
    """Names maximal runs of one symbol that span at most `cap` words; longer runs stay as they are."""
    cut = np.flatnonzero(names[1:] != names[:-1]) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(names)] - 1
    whole = (last > first) & (ends[last] - starts[first] <= cap)
    if not whole.any():
        return names, starts, ends
    length = last - first + 1
    inside = np.repeat(whole, length)
    leads = np.zeros(len(names), bool)
    leads[first] = True
    keep = ~inside | leads
    names, ends = names.copy(), ends.copy()
    run = first[whole]
    names[run] = mix(names[run] * _SPREAD + (length[whole] * 1000 + salt).astype(np.uint64))
    ends[run] = ends[last[whole]]
    return names[keep], starts[keep], ends[keep]


def _name_pairs(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, cap: int, salt: int):
    """Names neighbours of a left and a right symbol that span at most `cap` words together."""
    left = (mix(names + np.uint64(salt)) & np.uint64(1)).astype(bool)
    joins = left[:-1] & ~left[1:] & (ends[1:] - starts[:-1] <= cap)
    if not joins.any():
        return names, starts, ends
    head = np.flatnonzero(joins)
    keep = np.ones(len(names), bool)
    keep[head + 1] = False
    named, stops = names.copy(), ends.copy()
    named[head] = mix(names[head] * _SPREAD ^ mix(names[head + 1] + np.uint64(salt)))
    stops[head] = ends[head + 1]
    return named[keep], starts[keep], stops[keep]


def recompressed(items: np.ndarray, caps: tuple[int, ...] = CAPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first words and word ends of the symbols of a text after all rounds."""
    names, starts = items, np.arange(len(items))
    ends = starts + 1
    for level, cap in enumerate(caps):
        names, starts, ends = _name_runs(names, starts, ends, cap, 2 * level + 1)
        names, starts, ends = _name_pairs(names, starts, ends, cap, 2 * level + 2)
    return names, starts, ends


def anchor_stretches(items: np.ndarray, other: np.ndarray, width: int):
    """(key, full, first window, windows) arrays for the stretches of a piece of text."""
    windows, edge = len(items) - width + 1, margin()
    names, starts, _ = recompressed(items)
    # Symbols that start `edge` to width - edge - CAPS[-1] words into a window are sure to be the same in equal windows.
    reach = width - 2 * edge - CAPS[-1] + 1
    ranked = np.full(len(items), np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64((1 << 20) - 1)
    ranked[starts] = (names & ~low) | starts.astype(np.uint64)
    anchor = (window_minima(ranked[edge:], reach)[:windows] & low).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor) != 0) + 1
    first, last = np.r_[0, cut], np.r_[cut, windows] - 1
    mark = anchor[first]
    # The window may start edge to edge + reach - 1 words before its anchor; this lies in all of them.
    start, end = mark - edge, mark - edge - reach + 1 + width
    core = Sequence(items, 0).hashes(start, end)
    full = Sequence(other, 1).hashes(first, last + width) ^ (mark - first).astype(np.uint64) * _SPREAD
    return core.view(np.int64), full.view(np.int64), first, last - first + 1


def _level(width: int):
    def stretches(cell: int):
        def work(batches):
            def parts():
                for doc_id, data, text_key, *lists in few_copies(document_rows(batches), 1):
                    codes = np.frombuffer(data, np.uint8)
                    items, other = word_items(codes, 0), word_items(codes, 1)
                    if lists:
                        starts = windows_of(lists[0])
                        key = Sequence(items, 0).hashes(starts, starts + width).view(np.int64)
                        full = Sequence(other, 1).hashes(starts, starts + width).view(np.int64)
                        yield key, full, doc_id, starts << 16 | 1, text_key
                        continue
                    for low in range(0, len(items) - width + 1, PIECE):
                        piece = slice(low, low + PIECE + width - 1)
                        key, full, first, count = anchor_stretches(items[piece], other[piece], width)
                        yield key, full, doc_id, (first + low) << 16 | count, text_key

            yield from gathered(parts())

        return work

    return stretches


def windows_of(ats: list[int]) -> np.ndarray:
    """First words of all windows of the stretches in `ats`."""
    ats = np.sort(np.array(ats, np.int64))
    first, count = ats >> 16, ats & 0xFFFF
    return np.unique(np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()))


def later_windows(documents: DataFrame, width: int = 50) -> DataFrame:
    """`doc_id`, `text_key`, `at` of stretches whose every window also starts in a document with a smaller doc_id."""
    reach = width - 2 * margin() - CAPS[-1] + 1
    if reach < CAPS[-1]:
        raise ValueError(f"windows of {width} words are too short for symbols of {CAPS[-1]} words")
    # The document that has a stretch first stands for all, and has to be compared itself.
    return decided(documents, _level(width), (reach, 1), F.col("doc_id") > F.col("first_doc"),
                   F.col("doc_id") == F.col("first_doc"))


def remove_later(documents: DataFrame, width: int = 50) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_sha256`, `removed` per row; `removed` lists runs as start:end in words."""
    bound_batches(documents.sparkSession)
    texts = with_keys(documents)

    def work(rows):
        for doc_id, data, _, cuts in rows:
            codes = np.frombuffer(data or b"", np.uint8)
            starts, ends = word_bounds(codes)
            runs = list(zip((cuts or [])[::2], (cuts or [])[1::2]))
            keep = np.ones(len(starts), bool)
            for start, end in runs:
                keep[start:end] = False
            digest, blank = hashlib.sha256(), b""
            places = np.flatnonzero(keep)
            for low in range(0, len(places), 4096):
                part = places[low:low + 4096]
                digest.update(blank + b" ".join(
                    [data[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist())]))
                blank = b" "
            yield (doc_id, len(starts), int((~keep).sum()), digest.hexdigest(),
                   ",".join(f"{start}:{end}" for start, end in runs))

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string()), ("removed", pa.string())])
    return with_lists(texts, merged_runs(later_windows(texts, width), width), "left").mapInArrow(
        arrow_rows(work, schema),
        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed string")
