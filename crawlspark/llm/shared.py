"""Helpers of the operators: scratch tables, measured joins, connected components, Arrow batches."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.operators.joins import skew_safe_join

BROADCAST_BYTES = 32 * 1024 * 1024
BATCH_ROWS, BATCH_BYTES = 2000, 8 * 1024 * 1024
SLICE_BYTES = 2 * 1024 * 1024
STAR_ROWS, STAR_BYTES = 100_000, 48
STARS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
# Fixed value: the blanks that end a word.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}
_places: "WeakKeyDictionary[DataFrame, str]" = WeakKeyDictionary()


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "path" not in _own_folder:
            _own_folder["path"] = tempfile.mkdtemp(prefix="crawlspark-")
        folder = _own_folder["path"]
    return folder.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = f"{scratch_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def superseded(*tables: DataFrame) -> None:
    """Deletes tables that `kept` wrote, once nothing that is still to run reads them."""
    for table in tables:
        path = _places.pop(table)
        jvm = table.sparkSession.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def attach(left: DataFrame, lookup: DataFrame, on: list[str], size: Column, how: str = "left",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a table of texts to a derived table whose rows take `size` bytes.

    The derived table is measured first. Within the bound it is broadcast and no
    text moves; beyond it both sides are shuffled by a join that splits hot keys.
    """
    total = lookup.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]
    if total <= broadcast_bytes:
        return left.join(F.broadcast(lookup), on, how)
    return skew_safe_join(left, lookup, on, how)


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """`names`, each with as many leading underscores as it takes to be no column of `df`, whatever the case."""
    taken = {column.lower() for column in df.columns}
    while any(name.lower() in taken for name in names):
        names = tuple(f"_{name}" for name in names)
    return list(names)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bounds on Arrow batches to `BATCH_ROWS` rows and `BATCH_BYTES` bytes; never raises them.

    A batch is held by the executor and by its Python worker, and the executor keeps the memory.
    The settings stay, as plans read them when they run.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        setting = f"spark.sql.execution.arrow.{name}"
        own = spark.conf.get(setting).lower().removesuffix("b")
        # Zero and less stand for no bound; a value with a unit is left alone.
        if own.lstrip("-").isdigit() and not 0 < int(own) <= most:
            spark.conf.set(setting, str(most))


def arrow_rows(work: Callable, schema: pa.Schema, flush_rows: int = 20_000) -> Callable:
    """A `mapInArrow` function from `work`, which turns the Python rows of a batch into output rows (tuples).

    Text columns arrive as UTF-8 bytes. Rows become Python objects a few megabytes at a time, and
    `work(rows)` is a generator, so that results leave in bounded batches.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in source:
                columns = [column.cast(pa.binary()) if pa.types.is_string(column.type) else column
                           for column in batch.columns]
                step = slice_rows(batch)
                for start in range(0, batch.num_rows, step):
                    yield from zip(*[column.slice(start, step).to_pylist() for column in columns])

        out = []
        for row in work(rows()):
            out.append(row)
            if len(out) >= flush_rows:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    return batches


def slice_rows(batch: pa.RecordBatch) -> int:
    """How many rows of a batch to turn into Python objects at once."""
    return max(1, min(256, SLICE_BYTES * batch.num_rows // max(1, batch.nbytes)))


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)


def joined_stars(rows: Iterator[tuple], most: int) -> Iterator[tuple]:
    """Edges of stars that join the same ids as the edges `rows`; up to `most` ids are held at a time."""
    smaller: dict[int, int] = {}

    def root(id_):
        while (up := smaller.get(id_)) is not None:
            if (further := smaller.get(up)) is None:
                return up
            smaller[id_] = id_ = further
        return id_

    for a, b in rows:
        a, b = root(a), root(b)
        if a != b:
            smaller[max(a, b)] = min(a, b)
            if len(smaller) >= most:
                yield from [(id_, root(id_)) for id_ in smaller]
                smaller.clear()
    yield from [(id_, root(id_)) for id_ in smaller]


def components(edges: DataFrame) -> DataFrame:
    """`id`, `component`: the smallest id reachable from every id in `edges` (`a`, `b`).

    Tasks turn the edges they hold into stars, first as they lie, then round by round after a large-star step, dealt by
    their larger end, until all that is left are stars; each vertex then points at its smallest reachable id. As every
    edge comes from a star, an id has no more smaller neighbours than there were tasks, so no task of a round is hot.
    Edges stay distributed; only a count and a flag per round reach the driver, and up to `BROADCAST_BYTES` of
    smallest neighbours are broadcast.
    """
    stars = arrow_rows(partial(joined_stars, most=STAR_ROWS), STARS)
    pairs = edges.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    edges = kept(pairs.mapInArrow(stars, "a bigint, b bigint"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, high, below = F.min("b"), F.max("b"), F.max(F.when(F.col("b") < F.col("a"), F.col("b")))
        # An id that has a smaller neighbour is the point of a star where it has no other neighbours.
        least = kept(both.groupBy("a").agg(F.least(low, F.col("a")).alias("m"), F.coalesce(
            (low < below) | (below.isNotNull() & (high > F.col("a"))), F.lit(False)).alias("open")))
        size = least.agg(F.count("*").alias("n"), F.coalesce(F.max("open"), F.lit(False)).alias("open")).first()
        if not size["open"]:
            superseded(edges)
            return least.select(F.col("a").alias("id"), F.col("m").alias("component"))
        smallest = least.select("a", "m")
        if size["n"] * STAR_BYTES <= BROADCAST_BYTES:
            found = both.join(F.broadcast(smallest), ["a"])
        else:
            found = skew_safe_join(both, smallest, ["a"])
        large = found.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        older, edges = edges, kept(large.repartition("a").sortWithinPartitions("a").mapInArrow(stars, "a bigint, b bigint"))
        superseded(older, least)
