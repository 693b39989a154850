"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document is queued twice in its source, once per pass; passes are in an order
shuffled by the MD5 of doc_id. A queue entry finishes at (tokens of its source up to
and including it) / (target of its source); the mix is the entries in order of finish
time until the budget is used up.

Sizes are word counts, null texts count 0. A null source is a source of its own, last in
order. Entries with equal finish times follow source, pass, MD5, doc_id and size order.
Repeated rows are documents of their own; an empty table gives an empty result. Columns
other than doc_id, text and source are not looked at.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from crawlspark.llm.shared import WORD, attach, kept

# 10^11 documents: 2.4 x 10^7 in a slot of a source that owns all, 12,000 entries in a range of a range of finish times.
SLOTS = 4096


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """`queue`, `source_size`, `target` per source: shares of the budget by weight, each at most `most` times the size.

    The level L solves sum(min(L * weight, most * size)) = budget. Sources are tried
    in order of the level at which they are full.
    """
    per_source = sizes.groupBy("queue").agg(F.sum("size").alias("source_size"))
    by_name, overall = Window.orderBy("queue"), Window.partitionBy()
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    ranked = per_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    earlier = Window.orderBy(F.col("cap") / F.col("weight"), "queue").rowsBetween(Window.unboundedPreceding, -1)
    leveled = ranked.select(
        "*", ((F.sum("source_size").over(overall) * F.lit(share) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
              / (F.sum("weight").over(overall) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))).alias("tried"))
    level = F.max(F.when(F.col("cap") >= F.col("tried") * F.col("weight"), F.col("tried"))).over(overall)
    return leveled.select("queue", "source_size",
                          F.least(level * F.col("weight"), F.col("cap")).alias("target"))


def last_range(entries: DataFrame, budget: float) -> Row | None:
    """`range`, `before` (words of earlier ranges) of the range in which the budget ends; None where all fits.

    Ranges are summed, not sorted; one row reaches the driver.
    """
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    totals = entries.groupBy("range").agg(F.sum("size").alias("own")).withColumn("end", F.sum("own").over(upto))
    return totals.where(F.col("end") > F.lit(budget)).orderBy("range").select(
        "range", (F.col("end") - F.col("own")).alias("before")).first()


def mix(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
        most: int = 2) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken` per row: the words the mix takes, repeats counted.

    Sources in code point order get `weights`, repeated; the budget is `share` times
    all words; each document is queued `most` times.
    """
    sizes = kept(documents.select(
        "doc_id", F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("queue"),
        words(F.col("text")).alias("size"), F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("mix"),
    ).withColumn("slot", F.conv(F.concat(F.lit("0"), F.substring("mix", 1, 3)), 16, 10).cast("int") % SLOTS))
    targets = source_targets(sizes, weights, share, most)
    order = Window.partitionBy("queue", "slot").orderBy("mix", "doc_id", "size")
    slots = sizes.groupBy("queue", "slot").agg(F.sum("size").alias("slot_size"))
    before = Window.partitionBy("queue").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("queue", "slot", F.coalesce(F.sum("slot_size").over(before), F.lit(0)).alias("offset"))
    # The order above ends in whole rows, so rows that tie are equal: running rows, not ranges, keep them apart.
    running = sizes.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    queued = running.join(slots, ["queue", "slot"]).join(targets, "queue").select(
        "doc_id", "queue", "mix", "size", "source_size", "target", (F.col("offset") + F.col("within")).alias("upto"))
    queued = kept(queued.select("*", F.monotonically_increasing_id().alias("row")))
    entries = queued.where("size > 0 and target > 0").select(
        "row", "queue", "mix", "doc_id", "size", "target", "upto", "source_size",
        F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn"))
    entries = entries.withColumn(
        "finish", (F.col("upto") + F.col("turn") * F.col("source_size")).cast("double") / F.col("target"))
    # All sources use up their targets evenly over finish times 0 to 1, so equal ranges of time hold equal word counts.
    budget = sizes.agg((F.coalesce(F.sum("size"), F.lit(0)) * F.lit(share)).alias("budget")).first()["budget"]
    rest, used, parts = entries.withColumn("place", F.col("finish") * SLOTS), 0, []
    for _ in range(2):
        rest = rest.withColumn("range", F.least(F.floor("place"), F.lit(2 * SLOTS)).cast("int"))
        last = last_range(rest, budget - used)
        if last is None:
            break
        parts.append(rest.where(F.col("range") < last["range"]))
        rest, used = rest.where(F.col("range") == last["range"]), used + last["before"]
        rest = kept(rest.withColumn("place", (F.col("place") - F.col("range")) * SLOTS))
    # Only the entries of the last range of the last range have to be sorted.
    in_order = Window.partitionBy("range").orderBy("finish", "queue", "turn", "mix", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    parts.append(rest if last is None else rest.withColumn("end", F.sum("size").over(in_order)).where(
        F.col("end") <= F.lit(budget - used)))
    taken = reduce(DataFrame.union, [part.select("row", "size") for part in parts]).groupBy("row").agg(
        F.sum("size").alias("taken"))
    return queued.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                    most: int = 2) -> DataFrame:
    """The rows of `documents` that the mix takes, with `repeats`, how often each is used.

    Rows that share a doc_id are used equally often, as often as the first of them.
    Wordless texts take nothing of the budget and are left out, like rows without doc_id.
    """
    used = kept(mix(documents, weights, share, most).where("taken > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("taken") / F.col("size")).cast("int").alias("repeats")))
    return attach(documents.drop("repeats"), used, ["doc_id"], F.lit(40), "inner")
