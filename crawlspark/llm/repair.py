"""Conversation structure repair by weighted interval parsing.

A good conversation reads `(s?(ua)+)?` by the initials of its roles. The repair grammar is in Chomsky normal form. Its
nonterminals are pairs (p, q) of `STATES`: what leads a conversation from p to q. Rules are (p, q) -> (p, r)(r, q), lexical ones
are the edits of a row, and insertions are a closure over the empty span. A cell of a span holds the least (cost, audit) of each
nonterminal. Spans are combined bottom-up by length: two neighbours of equal length become one of twice the
length. As the language is regular, every split of a span gives the same cell, so one split does. Audits of
equal cost over one span are never prefixes of one another (the longer has more insertions), hence the least audit of a
span consists of least audits of its parts.

For the same reason a long conversation is cut into slices that are parsed in different tasks: narrow rows (roles,
faults, hashes) are range-partitioned by (conversation, turn, role, text hash), each task turns stretches of at most `SLICE`
rows into cells, and only cells meet. Rows seen before are found by a grouping that sums up
before it shuffles. Texts are shuffled once, at the end, to be read in order: the digest of a conversation has to pass its
rows one by one, as a stream; the task holds one audit and one batch.

Null roles and texts are one space, as is a null turn or conv_id in the hash that chooses the damage. Null turns come first;
rows of equal turn follow role, then a hash of the text. Rows without conv_id form one conversation. Repeated rows are
rows of their own. An empty table gives an empty result. Columns other than conv_id, turn, role and text are not looked at.
"""

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, bound_batches, kept
from crawlspark.operators.joins import skew_safe_join

SLICE = 4096
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: States of a good conversation: nothing yet, after s, after u, after a; and where each initial leads.
STATES = range(4)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FINAL = (0, 3)
BLANK = r"^[\x20\x09-\x0D]*$"
ENDED = r"[.!?][\x20\x09-\x0D]*$"

Cell = dict[tuple[int, int], tuple[int, str]]


def better(cell: Cell, key: tuple[int, int], cost: int, audit: str) -> None:
    if key not in cell or (cost, audit) < cell[key]:
        cell[key] = cost, audit


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: all rules (p, q) -> (p, r)(r, q)."""
    found: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (start, q), (more, rest) in right.items():
            if start == r:
                best = found.get((p, q))
                total = cost + more
                if best is None or total < best[0] or total == best[0] and audit + rest < best[1]:
                    found[p, q] = total, audit + rest
    return found


def closure() -> Cell:
    """The cell of the empty span: nothing, or the fewest rows of users and assistants that lead from p to q."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, r), (cost, audit) in list(cell.items()):
            for initial in "ua":
                if r in STEPS[initial]:
                    better(cell, (p, STEPS[initial][r]), cost + INSERT, audit + "I")
    return cell


EMPTY = closure()


def lexical(initial: str, faulty: bool, cut: bool) -> Cell:
    """The cell of one row, with insertions before it: kept, given another role, or deleted."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if not faulty:
        more = CUT if cut else 0
        for p, q in STEPS.get(initial, {}).items():
            better(cell, (p, q), KEEP + more, "K")
        for role in "ua":
            for p, q in STEPS[role].items():
                better(cell, (p, q), REROLE + more, "R")
    return joined(EMPTY, cell)


LEXICON = {(initial, faulty, cut): lexical(initial, faulty, cut)
           for initial in ("s", "u", "a", "") for faulty in (False, True) for cut in (False, True)}


def parsed(cells: Iterator[Cell]) -> Cell | None:
    """The cell of a stretch of neighbours: equal lengths are joined first, shorter rests at the end."""
    waiting: list[tuple[int, Cell]] = []
    for cell in cells:
        waiting.append((1, cell))
        while len(waiting) > 1 and waiting[-1][0] == waiting[-2][0]:
            (length, right), (_, left) = waiting.pop(), waiting.pop()
            waiting.append((2 * length, joined(left, right)))
    while len(waiting) > 1:
        (length, right), (more, left) = waiting.pop(), waiting.pop()
        waiting.append((length + more, joined(left, right)))
    return waiting[0][1] if waiting else None


def cheapest(cell: Cell | None) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation, insertions after the last row included."""
    whole = EMPTY if cell is None else joined(cell, EMPTY)
    return min(whole[0, q] for q in FINAL if (0, q) in whole)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row of the repaired conversation; roles not kept follow from their place."""
    place = -((len(audit) - audit.count("D")) % 2)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            yield edit, role if edit == "K" else ("user", "assistant")[place % 2], text
            place += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with damage done by the CRC-32 of `conv_id:turn`, modulo 20: dropped, emptied, without sentence ends, repeated, or
    with role user. Nulls of role and text become one space."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), way.alias("way"),
        text("role").alias("role"), text("text").alias("text")).where("way <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Narrow rows with `place`, their order: `conv_id`, `turn`, `initial`, `row_key`, `blank`, `cut`, `duplicate`."""
    key = F.struct(F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", "role")).alias("row_key")
    narrow = rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("text_key"), key, "copy",
                         F.col("text").rlike(BLANK).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"))
    # The last column deals out rows that are equal in all others.
    order = ("conv_id", "turn", "role", "text_key", "copy", "dealt")
    placed = kept(narrow.withColumn("dealt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "row_key", "blank", "cut",
        F.monotonically_increasing_id().alias("place")))
    seen = placed.groupBy("conv_id", "row_key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    # A null conv_id joins like any other.
    named = [F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("unnamed"), "row_key"]
    marked = skew_safe_join(placed.select("*", *named[:2]), seen.select(*named, "first"), ["conv", "unnamed", "row_key"], "left")
    return marked.select(*placed.columns, F.coalesce(F.col("place") > F.col("first"), F.lit(False)).alias("duplicate"))


def _packed(cell: Cell) -> list[tuple]:
    return [(p, q, cost, audit) for (p, q), (cost, audit) in sorted(cell.items())]


def _unpacked(cells: list[dict]) -> Cell:
    return {(cell["p"], cell["q"]): (cell["cost"], cell["audit"]) for cell in cells}


CELLS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
COUNTS = ("blank", "duplicate", "truncated", "illegal")
SLICES = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                    *[(name, pa.int64()) for name in COUNTS], ("cells", CELLS)])
SLICES_DDL = ("conv_id bigint, place bigint, first string, last string, blank bigint, duplicate bigint, truncated bigint, "
              "illegal bigint, cells array<struct<p int, q int, cost bigint, audit string>>")
GOOD = {"su", "ua", "au"}


def sliced(rows: DataFrame, most: int = SLICE) -> DataFrame:
    """Faults and cells of stretches of at most `most` neighbouring rows of a conversation that lie in one partition of the order."""

    def work(source):
        for (_, conv_id), group in groupby(source, key=lambda row: row[:2]):
            group = iter(group)
            while part := [row for _, row in zip(range(most), group)]:
                counts, cells, initials = dict.fromkeys(COUNTS, 0), [], [row[3].decode() for row in part]
                for initial, (*_, blank, duplicate, cut) in zip(initials, part):
                    fault = "blank" if blank else "duplicate" if duplicate else "truncated" if cut else None
                    if fault:
                        counts[fault] += 1
                    cells.append(LEXICON[initial if initial in STEPS else "", fault in ("blank", "duplicate"), fault == "truncated"])
                counts["illegal"] = sum(a + b not in GOOD for a, b in zip(initials, initials[1:]))
                yield (conv_id, part[0][2], initials[0], initials[-1], *counts.values(), _packed(parsed(iter(cells))))

    run = F.shiftright("place", 33)
    dealt = rows.withColumn("run", run).repartition("run").sortWithinPartitions("run", "place")
    return dealt.select("run", "conv_id", "place", "initial", "blank", "duplicate", "cut").mapInArrow(
        arrow_rows(work, SLICES, flush_rows=500), SLICES_DDL)


PARSED = pa.schema([("conv_id", pa.int64()), *[(name, pa.int64()) for name in (*COUNTS, "cost")], ("audit", pa.string())])


def combined(slices: DataFrame) -> DataFrame:
    """Faults, cost and audit per conversation from its slices."""

    def work(source):
        for conv_id, group in groupby(source, key=lambda row: row[0]):
            totals, before = [0] * len(COUNTS), None

            def cells():
                nonlocal before
                for _, _, first, last, *counts, packed in group:
                    totals[:] = [total + count for total, count in zip(totals, counts)]
                    totals[-1] += before is not None and before + first.decode() not in GOOD
                    before = last.decode()
                    yield _unpacked(packed)

            cost, audit = cheapest(parsed(cells()))
            yield (conv_id, *totals, cost, audit)

    ordered = slices.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(arrow_rows(work, PARSED), "conv_id bigint, blank bigint, duplicate bigint, truncated bigint, "
                                                        "illegal bigint, cost bigint, audit string")


def turn_gaps(rows: DataFrame) -> DataFrame:
    """`conv_id`, `gaps`: turns missing between the first and the last."""
    distinct = rows.select("conv_id", "turn").distinct()
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return distinct.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"))


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                      ("text", pa.string())])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: `conv_id`, `place` (from 0), `edit` (K, R or I), `role`, `text`.

    `audits` has one for every conversation of `rows`. Rows of a conversation lie in one partition, in order.
    """

    def work(source):
        for conv_id, group in groupby(source, key=lambda row: row[0]):
            audit = next(group)[2].decode()
            texts = ((role.decode("utf-8", "replace"), text.decode("utf-8", "replace")) for _, _, role, text in group)
            for place, row in enumerate(edited(audit, texts)):
                yield conv_id, place, *row

    nothing = F.lit(None).cast("bigint")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("role"), F.lit("").alias("text"),
                          nothing.alias("turn"), nothing.alias("text_key"), F.lit(0).alias("copy"))
    bodies = rows.select("conv_id", F.lit(1).alias("kind"), "role", "text", "turn", F.xxhash64("text").alias("text_key"), "copy")
    ordered = heads.union(bodies).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", "turn", "role", "text_key", "copy")
    return ordered.select("conv_id", "kind", "role", "text").mapInArrow(
        arrow_rows(work, REPAIRED, flush_rows=2000), "conv_id bigint, place bigint, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """`conv_id`, `repaired_sha256` of `repaired_rows`: `role:text` of all rows, joined by newlines, as a stream."""

    def work(source):
        for conv_id, group in groupby(source, key=lambda row: row[0]):
            whole = hashlib.sha256()
            for _, place, role, text in group:
                whole.update((b"\n" if place else b"") + role + b":" + text)
            yield conv_id, whole.hexdigest()

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(
        arrow_rows(work, DIGESTS), "conv_id bigint, repaired_sha256 string")


def repaired(rows: DataFrame, every: DataFrame, most: int = SLICE) -> DataFrame:
    """Faults and the cheapest repair of the conversations of `rows`, one row for each conv_id of `every`.

    `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`, `repaired_sha256`. `rows` are
    `conv_id`, `turn`, `role`, `text` (no nulls) and `copy`, which tells repeated rows apart.
    """
    bound_batches(rows.sparkSession)
    audits = kept(combined(kept(sliced(ordered_rows(rows), most))))
    parts = [audits, turn_gaps(rows), digests(repaired_rows(rows, audits))]
    zero = F.lit(0).cast("bigint")
    defaults = {"gaps": zero, **{name: zero for name in (*COUNTS, "cost")}, "audit": F.lit(""),
                "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    # Every table has one row per conversation; values that are not its own are null, and one grouping puts them together.
    whole = every.select(F.col("conv_id").cast("bigint").alias("conv_id"))
    for part in parts:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.groupBy("conv_id").agg(*[F.coalesce(F.max(name), default).alias(name) for name, default in defaults.items()])
