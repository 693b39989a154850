"""Finding windows that repeat, by sorting stretches of windows across the cluster.

A stretch is a run of neighbouring windows of one document that share an anchor: a place
picked by the windows' own content, so that equal windows pick equal anchors. A stretch
row has

- `key`: leading content of the stretch's core, then the core's fingerprint. The core is
  the part around the anchor that lies within every window that can share it;
- `full`: a fingerprint of all the stretch covers, which says when whole stretches are equal;
- `doc_id`, and `at`: first window times 2^16 plus number of windows;
- `text_key`: a hash of the whole text. Rows are told apart by doc_id and text_key, so texts that share a doc_id are
  texts of their own; rows equal in both have equal stretches, and a task gives those of a few of them only.

Equal windows lie in stretches of equal `key`. The rows are range-partitioned by splitters
that Spark samples, each bucket is sorted by multikey quicksort, neighbours are compared,
and what touches a bucket's ends is settled from one summary row per bucket. The order ends in
doc_id and `at`, so a passage shared by a third of all documents spreads over buckets.

A stretch alone under its key holds no repeat. Equal stretches repeat as a whole. Where unlike
stretches share a key, they are cut into shorter stretches that are sorted again, down to single windows
(`decided`). Only stretches where a match begins or ends get that far.
"""

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, attach, kept, superseded

STRETCH = "key bigint, full bigint, doc_id bigint, at bigint"
STRETCH_SCHEMA = pa.schema([(name, pa.int64()) for name in ("key", "full", "doc_id", "at")])
ROW_STRETCH = f"{STRETCH}, text_key bigint"
ROW_STRETCH_SCHEMA = STRETCH_SCHEMA.append(pa.field("text_key", pa.int64()))
ROW = ["doc_id", "text_key"]
_FLAGS = ("same", "unlike", "first", "head_key", "head_full", "tail_key", "tail_full")
_SORTED = f"bucket int, {ROW_STRETCH}, first_doc bigint, key_first bigint, " + ", ".join(f"{name} boolean" for name in _FLAGS)


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their words: sort by the first word, then only ties by the next, and so on."""
    order = np.argsort(words[0], kind="quicksort")
    if len(words) == 1 or len(order) < 2:
        return order
    ranked = words[0][order]
    # `group` numbers equal rows so far; rows whose group has one member are in place.
    group = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
    for word in words[1:]:
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        rows, groups = order[tied], group[tied]
        inner = np.lexsort((word[rows], groups))
        order[tied] = rows[inner]
        value = word[order]
        changed = (value[1:] != value[:-1]) | (group[1:] != group[:-1])
        group = np.r_[0, np.cumsum(changed)]
    return order


def _sorted_bucket(batches):
    tables = [batch for batch in batches if batch.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables).combine_chunks()
    words = [table.column(name).to_numpy() for name in ("key", "full", "doc_id", "text_key", "at")]
    del tables, table
    order = multikey_order(words)
    key, full, doc, text, at = (word[order] for word in words)
    del words, order
    new_key = np.r_[True, key[1:] != key[:-1]]
    new_full = new_key | np.r_[True, full[1:] != full[:-1]]
    key_id, full_id = np.cumsum(new_key) - 1, np.cumsum(new_full) - 1
    firsts = np.flatnonzero(new_full)
    same = np.bincount(full_id)[full_id] > 1
    unlike = np.bincount(key_id[firsts])[key_id] > 1
    columns = {
        "key": key, "full": full, "doc_id": doc, "at": at, "text_key": text, "first_doc": doc[firsts][full_id],
        "key_first": doc[np.flatnonzero(new_key)][key_id], "same": same, "unlike": unlike, "first": new_full,
        "head_key": key_id == 0, "head_full": full_id == 0, "tail_key": key_id == key_id[-1],
        "tail_full": full_id == full_id[-1]}
    use = np.flatnonzero(same | unlike | columns["head_key"] | columns["tail_key"])
    bucket = TaskContext.get().partitionId()
    for start in range(0, len(use), 50_000):
        rows = use[start:start + 50_000]
        arrays = [pa.array(np.full(len(rows), bucket, np.int32))]
        arrays += [pa.array(np.ascontiguousarray(values[rows])) for values in columns.values()]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def _across(summaries: list) -> list[tuple]:
    """What each bucket's first and last groups owe to other buckets.

    One pass forwards carries the open key and full groups on, one backwards
    completes what a group learns only later.
    """
    summaries = sorted(summaries, key=lambda row: row["bucket"])
    out = [dict(bucket=row["bucket"], head_same=False, tail_same=False, head_unlike=False, tail_unlike=False,
                head_doc=None, head_key_first=None) for row in summaries]
    carry_doc = carry_key_first = None
    for place in range(len(summaries)):
        row, before = summaries[place], summaries[place - 1] if place else None
        one_key, one_full = row["one_key"], row["one_full"]
        if before is not None and before["last_key"] == row["first_key"]:
            out[place]["head_key_first"] = carry_key_first
            differs = before["last_full"] != row["first_full"]
            out[place]["head_unlike"] |= differs or before["tail_unlike"] or out[place - 1]["tail_unlike"]
            if not differs:
                out[place]["head_same"] = out[place - 1]["tail_same"] = True
                out[place]["head_doc"] = carry_doc
        if one_key:
            out[place]["tail_unlike"] |= out[place]["head_unlike"]
        carry_doc = out[place]["head_doc"] if one_full and out[place]["head_doc"] is not None else row["tail_doc"]
        carry_key_first = (out[place]["head_key_first"] if one_key and out[place]["head_key_first"] is not None
                           else row["tail_key_first"])
    for place in range(len(summaries) - 2, -1, -1):
        row, after = summaries[place], summaries[place + 1]
        if row["last_key"] == after["first_key"]:
            out[place]["tail_unlike"] |= (row["last_full"] != after["first_full"] or after["head_unlike"]
                                          or out[place + 1]["head_unlike"])
            if row["one_key"]:
                out[place]["head_unlike"] |= out[place]["tail_unlike"]
        if row["one_full"]:
            out[place]["head_same"] |= out[place]["tail_same"]
    for place, row in enumerate(summaries):
        if row["one_full"]:
            both = out[place]["head_same"] or out[place]["tail_same"]
            out[place]["head_same"] = out[place]["tail_same"] = both
    return [tuple(row.values()) for row in out]


def shared_stretches(stretches: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of `stretches` (`key`, `full`, `doc_id`, `at`, and `text_key` or 0) whose key occurs more than once.

    Adds `same`: an equal stretch is elsewhere; `unlike`: a stretch with this key and another
    content exists; `first_doc`: the smallest doc_id with an equal stretch; `key_first`:
    the doc_id of the key's first row; `first`: the first of equal stretches.
    """
    spark = stretches.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sampling for the splitters reads the rows once more: from a table, as hashing the texts takes longer.
    source = kept(stretches)
    dealt = source if "text_key" in source.columns else source.withColumn("text_key", F.lit(0).cast("bigint"))
    dealt = dealt.repartitionByRange(count, "key", "full", "doc_id", "text_key", "at")
    rows = kept(dealt.mapInArrow(_sorted_bucket, _SORTED))
    superseded(source)
    when = lambda flag, name: F.when(F.col(flag), F.col(name))
    summaries = rows.groupBy("bucket").agg(
        F.max(when("head_key", "key")).alias("first_key"), F.max(when("head_full", "full")).alias("first_full"),
        F.max(when("tail_key", "key")).alias("last_key"), F.max(when("tail_full", "full")).alias("last_full"),
        F.min(when("tail_full", "first_doc")).alias("tail_doc"), F.max(when("tail_key", "key_first")).alias("tail_key_first"),
        F.max(when("head_key", "unlike")).alias("head_unlike"), F.max(when("tail_key", "unlike")).alias("tail_unlike"),
        F.bool_or(F.col("head_key") & F.col("tail_key")).alias("one_key"),
        F.bool_or(F.col("head_full") & F.col("tail_full")).alias("one_full"))
    # One row per bucket, so the driver's share is bounded by the number of partitions.
    across = spark.createDataFrame(
        _across(summaries.collect()),
        "bucket int, head_same boolean, tail_same boolean, head_unlike boolean, tail_unlike boolean, head_doc bigint, "
        "head_key_first bigint")
    joined = rows.join(F.broadcast(across), "bucket")
    return joined.select(
        "key", "full", "doc_id", "at", "text_key",
        (F.col("same") | (F.col("head_full") & F.col("head_same")) | (F.col("tail_full") & F.col("tail_same"))).alias("same"),
        (F.col("unlike") | (F.col("head_key") & F.col("head_unlike"))
         | (F.col("tail_key") & F.col("tail_unlike"))).alias("unlike"),
        F.when(F.col("head_full"), F.coalesce("head_doc", "first_doc")).otherwise(F.col("first_doc")).alias("first_doc"),
        F.when(F.col("head_key"), F.coalesce("head_key_first", "key_first")).otherwise(F.col("key_first")).alias("key_first"),
        (F.col("first") & ~(F.col("head_full") & F.col("head_doc").isNotNull())).alias("first"),
    ).where("same or unlike")


def with_lists(documents: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """`doc_id`, `text`, `text_key`, `list` of documents and their lists of numbers, each bounded by its document's length."""
    return attach(documents.select(*ROW, "text"), kept(lists), ROW, F.size("list") * 8 + 72, how).select(
        "doc_id", "text", "text_key", "list")


def with_keys(documents: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `text_key` of documents."""
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))


def few_copies(rows, most: int):
    """Rows (doc_id, text, text_key, ...) that have a doc_id and a text, of equal ones `most`. The memory is that of a task's ids."""
    seen: dict[tuple, int] = {}
    for row in rows:
        if row[0] is None or not row[1]:
            continue
        known = row[0], row[2]
        seen[known] = seen.get(known, 0) + 1
        if seen[known] <= most:
            yield row


def decided(documents: DataFrame, level: Callable, cells: tuple[int, ...], goes: Column, compared: Column) -> DataFrame:
    """`doc_id`, `text_key`, `at` of the stretches that repeat as `goes` asks, looked for level by level.

    `documents` come from `with_keys`. `level(cell)` gives a `mapInArrow` function that makes stretches of at most `cell`
    windows, from whole texts first, then from texts with the list of open stretches.
    `compared` picks, among equal stretches that unlike ones share a key with, those
    that stand for all of them.
    """
    rows, found = documents.mapInArrow(level(cells[0]), ROW_STRETCH), []
    for cell in (*cells[1:], None):
        shared = shared_stretches(rows)
        found.append(shared.where(goes).select(*ROW, "at"))
        if cell is not None:
            open_rows = shared.where("unlike").where(compared)
            # A set, as copies of a row name the same places: no list is longer than its text.
            lists = open_rows.groupBy(*ROW).agg(F.collect_set("at").alias("list"))
            rows = with_lists(documents, lists, "inner").mapInArrow(level(cell), ROW_STRETCH)
    return reduce(DataFrame.union, found)


def covered(ats: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged, sorted starts and ends of what the windows in `ats` cover. Touching runs are one."""
    ats = np.sort(np.asarray(ats, np.int64))
    starts = ats >> 16
    ends = np.maximum.accumulate(starts + (ats & 0xFFFF) - 1 + width)
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return starts[np.r_[0, cut]], ends[np.r_[cut - 1, len(ends) - 1]]


def merged_runs(rows: DataFrame, width: int) -> DataFrame:
    """`doc_id`, `text_key` and `list`: starts and ends, in turn, of what the stretches of `rows` cover."""

    def work(source):
        for doc_id, text_key, ats in source:
            yield doc_id, text_key, np.column_stack(covered(ats, width)).ravel().tolist()

    lists = rows.groupBy(*ROW).agg(F.collect_set("at").alias("list"))
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("list", pa.list_(pa.int64()))])
    return lists.mapInArrow(arrow_rows(work, schema, flush_rows=1000), "doc_id bigint, text_key bigint, list array<bigint>")
