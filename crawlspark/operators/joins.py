"""Joins that hold up when one key owns a large share of the rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def skew_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join whose two inputs always arrive through plain shuffles.

    Adaptive execution splits a hot partition only when both inputs of the join
    are bare shuffles. An input that is already partitioned by the key (an
    aggregate, a window) would be joined in place and could not be split. A hash
    of the key as an extra join key asks for a fresh shuffle on both sides, and
    a right side that turns out small at run time is still broadcast. The hash is
    part of the condition and no column, so that no shuffle carries it.
    """
    keys = list(on)
    other = {key: f"__right_{key}" for key in keys}
    meets = F.xxhash64(*keys) == F.xxhash64(*other.values())
    for key, name in other.items():
        meets = (F.col(key) == F.col(name)) & meets
    joined = left.join(right.withColumnsRenamed(other), meets, how)
    if how in ("left_semi", "left_anti"):
        return joined
    key_of = {"full": lambda key: F.coalesce(key, other[key]).alias(key), "right": lambda key: F.col(other[key]).alias(key)}
    shown = [key_of.get(how, F.col)(key) for key in keys]
    return joined.select(*shown, *[name for name in (*left.columns, *right.columns) if name not in keys])


def table_bytes(df: DataFrame) -> int:
    """Rough in-memory size of a table of strings and numbers. Runs one aggregate job."""
    row = F.lit(16)
    for field in df.schema.fields:
        if field.dataType.simpleString() in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            row = row + 16
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def settled(df: DataFrame) -> DataFrame:
    """A small derived table that several parts of a plan use, written once where the cluster allows it.

    Where a shared checkpoint folder is configured (`spark.checkpoint.dir`) the
    table is checkpointed there, so it is computed once and outlives lost
    executors. Elsewhere it is returned as it is and computed where it is used.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            return df
        context.setCheckpointDir(folder)
    # Run as a frame of its own, which nothing holds on to: the files of its shuffles go when the driver collects its garbage.
    written = df.select("*").checkpoint()
    context._jvm.System.gc()
    return written


def lookup_join(left: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a large table to a lookup table of flat columns.

    Measures the lookup table first (one aggregate job): within the bound it is
    broadcast and the large side is not moved at all; beyond it the join falls
    back to `skew_safe_join`.
    """
    if table_bytes(lookup) <= broadcast_bytes:
        return left.join(F.broadcast(lookup), list(on), how)
    return skew_safe_join(left, lookup, on, how)
