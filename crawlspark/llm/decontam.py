"""Benchmark decontamination by spaced-seed hashing.

Words are compared without case (Unicode case folding) and ASCII punctuation. An overlap is a stretch of `LEAST` aligned
words of an item and a document of which at most `ERRORS` differ (substitutions). The stretch is cut
into four blocks; each of six masks ignores two of them. Two errors touch at most two blocks, so
some mask hashes alike in every overlap: the join of test and training hashes misses none.
Each hit is verified by comparing the words along its alignment.

Items are searched in blocks of bounded size, each broadcast as a sorted hash table and joined
to all documents in one pass; a larger benchmark takes more passes. A block's hits are written and its
broadcast is released before the next, so the driver holds one block at a time; an item is not split. Items of fewer than
`LEAST` words, and at least `TOLERANT`, count where they occur as a whole with at most one word replaced
(`ERRORS` scaled to their length): one of their halves is intact there, and is what is looked for.
Shorter items, down to one word, count where they occur as a whole, unchanged. Such items occur by chance too:
who does not want them leaves them out of the benchmark. Null and wordless items are not looked
for; text without blanks between words counts as one word.

Null documents overlap nothing. `contaminated` reports repeated rows once per doc_id, with what any of its rows
overlaps, and no rows without doc_id; `remove_contaminated` decides on every row's own text, with or without
doc_id. Equal items are reported under their smallest item_id. Empty tables give an empty
result; columns other than doc_id, item_id and text are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.fingerprints import Sequence, mix, word_items
from crawlspark.llm.mixing import words
from crawlspark.llm.shared import arrow_rows, attach, bound_batches, kept, unused_names

LEAST, ERRORS, TOLERANT = 13, 2, 8
BLOCK_WORDS = 500_000
PIECE = 1 << 14
_CUTS = np.linspace(0, LEAST, 5).round().astype(int)
_MASKS = list(combinations(range(4), 2))
_BITS = 22

_FOLD = np.full(256, 32, np.uint8)
for _codes in (range(48, 58), range(97, 123), range(128, 256)):
    _FOLD[list(_codes)] = list(_codes)


def folded_words(data: bytes | None) -> np.ndarray:
    """Fingerprints of a text's words without case and ASCII punctuation."""
    folded = (data or b"").decode("utf-8", "replace").casefold().encode()
    return word_items(_FOLD[np.frombuffer(folded, np.uint8)], 0)


def masked_hashes(items: np.ndarray) -> np.ndarray:
    """For every start of `LEAST` words, a hash per mask: (masks, starts)."""
    starts = np.arange(max(0, len(items) - LEAST + 1))
    sequence = Sequence(items, 0)
    blocks = [sequence.hashes(starts + _CUTS[block], starts + _CUTS[block + 1]) for block in range(4)]
    return np.array([mix(blocks[a] * np.uint64(3) + blocks[b] + np.uint64(place + 1))
                     for place, (a, b) in enumerate(_MASKS)]).reshape(len(_MASKS), len(starts))


def replaced(length: int) -> int:
    """How many words of a short item may be replaced where it occurs."""
    return ERRORS * length // LEAST if length >= TOLERANT else 0


def cuts(length: int) -> list[tuple[int, int]]:
    """The parts of a short item, one of which is unchanged wherever it occurs."""
    return [(0, length // 2), (length // 2, length)] if replaced(length) else [(0, length)]


class Items:
    """A block of benchmark items with the hashes of its seeds."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = [item_id for item_id, _ in rows]
        self.words = [folded_words(data) for _, data in rows]
        hashes, owners, places, self.short = [], [], [], {}
        for owner, items in enumerate(self.words):
            if len(items) >= LEAST:
                own = masked_hashes(items)
                hashes.append(own.ravel())
                owners.append(np.full(own.size, owner))
                places.append(np.tile(np.arange(own.shape[1]), len(_MASKS)))
            elif len(items):
                for first, last in cuts(len(items)):
                    value = int(Sequence(items, 0).hashes(np.array([first]), np.array([last]))[0])
                    self.short.setdefault((len(items), first, last), {}).setdefault(value, []).append(owner)
        #: The cut hashes of short items in order, to tell whole pieces of a text that hold none.
        self.cut_hashes = {cut: np.array(sorted(known), np.uint64) for cut, known in self.short.items()}
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.hashes, self.owners, self.places = join(hashes, np.uint64), join(owners, np.int64), join(places, np.int64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.owners, self.places = self.hashes[order], self.owners[order], self.places[order]
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.hashes >> np.uint64(64 - _BITS)] = True

    def overlaps(self, data: bytes | None) -> dict[int, int]:
        """Item number to the number of its words that agree within overlaps."""
        items, found = folded_words(data), {}
        for low in range(0, len(items), PIECE):
            # Alignments reach as far as an item does on either side of the piece.
            self._search(items, low, min(len(items), low + PIECE + LEAST - 1), found)
        return {owner: int(agree.sum()) for owner, agree in found.items()}

    def _search(self, items: np.ndarray, low: int, high: int, found: dict[int, np.ndarray]) -> None:
        hashed = masked_hashes(items[low:high])
        mask, start = np.nonzero(self.known[hashed >> np.uint64(64 - _BITS)])
        values = hashed[mask, start]
        first, last = np.searchsorted(self.hashes, values), np.searchsorted(self.hashes, values, side="right")
        tried = set()
        for place in np.flatnonzero(last > first).tolist():
            for entry in range(first[place], last[place]):
                owner = int(self.owners[entry])
                shift = low + int(start[place]) - int(self.places[entry])
                if (owner, shift) not in tried:
                    tried.add((owner, shift))
                    self._verify(items, owner, shift, found)
        sequence = Sequence(items[low:high], 0)
        for (length, first, last), known in self.short.items():
            starts = np.arange(max(0, high - low - length + 1))
            values = sequence.hashes(starts + first, starts + last)
            for start in np.flatnonzero(np.isin(values, self.cut_hashes[length, first, last])).tolist():
                for owner in known[int(values[start])]:
                    agree = self.words[owner] == items[low + start:low + start + length]
                    if length - agree.sum() <= replaced(length):
                        found[owner] = found.get(owner, np.zeros(length, bool)) | agree

    def _verify(self, items: np.ndarray, owner: int, shift: int, found: dict[int, np.ndarray]) -> None:
        own = self.words[owner]
        first, last = max(0, -shift), min(len(own), len(items) - shift)
        agree = own[first:last] == items[first + shift:last + shift]
        sums = np.r_[0, np.cumsum(agree)]
        good = np.flatnonzero(sums[LEAST:] - sums[:-LEAST] >= LEAST - ERRORS)
        if len(good):
            inside = np.zeros(len(own), bool)
            for start in good:
                inside[first + start:first + start + LEAST] = agree[start:start + LEAST]
            found[owner] = found.get(owner, np.zeros(len(own), bool)) | inside


def overlapping(texts: DataFrame, keys: list[str], benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The `keys` (bigint columns) of each of `texts` with an overlap, `item_id` and `n_words` (words that agree)."""
    bound_batches(texts.sparkSession)
    items = kept(benchmark.where("text is not null and item_id is not null").groupBy("text").agg(
        F.min("item_id").cast("bigint").alias("item_id")).withColumn("words", words(F.col("text"))))
    total = items.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()["words"]
    # Items are dealt to blocks by a hash of their id.
    blocks = max(1, -(-total // block_words))
    names = [*keys, "item_id", "n_words"]
    schema = pa.schema([(name, pa.int64()) for name in names])
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).select("item_id", "text").collect()
        table = texts.sparkSession.sparkContext.broadcast(
            Items([(row["item_id"], row["text"].encode()) for row in sorted(own)]))

        def work(rows, table=table):
            searched = table.value
            for *key, data in rows:
                for owner, agree in searched.overlaps(data).items():
                    yield *key, searched.ids[owner], agree

        part = texts.select(*keys, "text").mapInArrow(
            arrow_rows(work, schema), ", ".join(f"{name} bigint" for name in names))
        if blocks > 1:
            part = kept(part)
            table.destroy()
        found = part if found is None else found.union(part)
    return found


def contaminated(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`doc_id`, `n_items`, `n_words` (words that agree, summed over items), `items` per document with an overlap."""
    texts = documents.selectExpr("cast(doc_id as bigint) as doc_id", "text").where("doc_id is not null")
    found = overlapping(texts, ["doc_id"], benchmark, block_words)
    per_item = found.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))
    return per_item.groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.sum("n_words").alias("n_words"),
        F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`documents` without the rows whose text overlaps a benchmark item.

    Texts are told apart by two 64-bit hashes, so doc_id plays no part: rows without one, and different texts under
    one, each go or stay for what they say.
    """
    first, second = keys = unused_names(documents, "text_hash", "text_hash_2")
    keyed = documents.withColumns({first: F.xxhash64("text"), second: F.xxhash64("text", F.lit("second"))})
    found = kept(overlapping(keyed, keys, benchmark).select(*keys).distinct())
    return attach(keyed, found, keys, F.lit(32), "left_anti").select(*documents.columns)
