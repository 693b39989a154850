"""Near duplicates by a multi-index Hamming join over b-bit MinHash signatures, confirmed on full sets.

A text's set holds the distinct `shingle`-word shingles of its words, A-Z in lower case; fewer words
make one shingle. Texts of one set form a class, represented by its smallest doc_id. A
signature has 64 components of 16 bits; the distance of two is the number of components
that differ. It is split into 14 chunks, and every chunk is listed once for each of its
components, that one left out: chunks with at most one error meet. By the pigeonhole
principle every pair at a distance up to 27 meets (14 x 2 = 28 errors are needed to avoid it).
At similarity 0.8 a distance over 27 has a chance of about 10^-5; such pairs
still mostly meet, and what met is compared up to a distance of 34, which is exceeded with a chance of about 10^-9.

Only connections are asked for, so pairs already connected are not compared:
1. every class is compared with the bucket head it meets most often;
2. classes that still share a bucket with another component form clusters, connected by buckets. A cluster whose classes lie in
   many common buckets is compared as a whole: its classes are dealt out once to blocks of about `BLOCK` classes or
   `VOLUME` shingles, and every pair of blocks is one group of rows with full sets. A class travels once for each block of its
   cluster, not once for each bucket, and no pair is listed;
3. in wide clusters of few common buckets, where that would cost more, bucket mates are compared bucket by bucket: with the
   nearest of another component, twice, then all that are still apart.
All ways check the same pairs, those that meet at a distance up to 34, on full shingle sets, and none is left unchecked.
Blocks bound the rows and shingles of a task, whatever the size of a group.

Empty sets (null, empty or wordless texts) link with nothing. Repeated rows are copies. Rows that share
a doc_id but not a text are texts of their own, linked by what they say, under the same id. Rows without doc_id are not
linked and never kept. An empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.fingerprints import Sequence, mix, word_items
from crawlspark.llm.repeats import STRETCH, shared_stretches
from crawlspark.llm.shared import arrow_rows, attach, bound_batches, components, kept, superseded, unused_names
from crawlspark.llm.suffixes import document_rows, gathered
from crawlspark.operators.joins import skew_safe_join

COMPONENTS, CHUNKS, FARTHEST = 64, 14, 34
BLOCK, VOLUME = 2048, 1 << 21
_rng = np.random.default_rng(8)
_FACTORS = _rng.integers(0, 1 << 63, COMPONENTS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, COMPONENTS, np.uint64)
_BOUNDS = np.linspace(0, COMPONENTS, CHUNKS + 1).round().astype(int)
#: For every key slot, its chunk and whether it is the first of that chunk.
_CHUNK_OF = np.repeat(np.arange(CHUNKS), np.diff(_BOUNDS))
_FIRST_OF = np.isin(np.arange(COMPONENTS), _BOUNDS[:-1])
#: Weights of the components in each slot's key: those of its chunk but the one left out.
_WEIGHTS = np.where((_CHUNK_OF[:, None] == _CHUNK_OF[None, :]) & ~np.eye(COMPONENTS, dtype=bool),
                    _rng.integers(0, 1 << 63, (COMPONENTS, COMPONENTS), np.uint64) * np.uint64(2) + np.uint64(1),
                    np.uint64(0))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_set(data: bytes | None, shingle: int) -> np.ndarray:
    """Sorted distinct shingle fingerprints of a text."""
    items = word_items(_LOWER[np.frombuffer(data or b"", np.uint8)], 0)
    if not len(items):
        return items
    width = min(shingle, len(items))
    starts = np.arange(len(items) - width + 1)
    return np.unique(Sequence(items, 0).hashes(starts, starts + width))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        hashed = shingles[start:start + 1024][None, :] * _FACTORS[:, None] + _SHIFTS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return (mix(least) >> np.uint64(48)).astype(np.uint16)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
NEAREST = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("distance", pa.int64())])
PARTNERS = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("id", pa.int64()),
                      ("comp", pa.int64()), ("partners", pa.list_(pa.int64()))])


def profiles(documents: DataFrame, shingle: int) -> DataFrame:
    """`doc_id`, `n_shingles`, `f1`, `f2` (a fingerprint of the set), `signature` and `text_key` per row."""

    def work(rows):
        for doc_id, data, text_key in rows:
            shingles = shingle_set(data, shingle)
            sums = [int(mix(shingles ^ np.uint64(salt)).sum().view(np.int64)) for salt in (1, 2)]
            yield doc_id, len(shingles), *sums, signature(shingles).tobytes() if len(shingles) else None, text_key

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("signature", pa.binary()), ("text_key", pa.int64())])
    return documents.select("doc_id", "text", F.xxhash64("text")).mapInArrow(
        arrow_rows(work, schema),
        "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, signature binary, text_key bigint")


def _keys(batches):
    def parts():
        for doc_id, data in document_rows(batches):
            components_ = np.frombuffer(data, np.uint16).astype(np.uint64)
            keys = mix((_WEIGHTS * components_).sum(axis=1) + np.arange(COMPONENTS, dtype=np.uint64))
            yield keys.view(np.int64), np.full(COMPONENTS, doc_id, np.int64), doc_id, np.arange(COMPONENTS)

    yield from gathered(parts())


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Errors per chunk for all pairs of two blocks of signatures."""
    return np.add.reduceat((left[:, None, :] != right[None, :, :]).view(np.int8), _BOUNDS[:-1], axis=2, dtype=np.int16)


def _block_pairs(nearest: bool):
    """What a bucket block has to compare: each left row with its nearest, or with a list of all its partners.

    In the second case rows of side 0 carry their partners and rows of side 1 say who
    is needed as a partner, so that a block's rows grow with its members, not its pairs.
    """

    def work(rows):
        for (key, i, j), group in groupby(rows, key=lambda row: row[:3]):
            group = list(group)
            sides = [[row for row in group if row[3] == side] for side in (0, 1)]
            if not sides[0] or not sides[1]:
                continue
            slot = group[0][4]
            ids, comps, major, signs = [], [], [], []
            for side in sides:
                ids.append(np.array([row[5] for row in side]))
                comps.append(np.array([row[6] for row in side]))
                major.append(np.array([row[7] for row in side]))
                signs.append(np.frombuffer(b"".join(row[8] for row in side), np.uint16).reshape(-1, COMPONENTS))
            needed = np.zeros(len(ids[1]), bool)
            for start in range(0, len(ids[0]), 64):
                part = slice(start, start + 64)
                errors = _distances(signs[0][part], signs[1])
                distance = errors.sum(axis=2)
                good = (comps[0][part, None] != comps[1][None, :]) & (distance <= FARTHEST)
                if nearest:
                    distance = np.where(good, distance, 99)
                    best = distance.argmin(axis=1)
                    for row in np.flatnonzero(good.any(axis=1)).tolist():
                        yield int(ids[0][part][row]), int(ids[1][best[row]]), int(distance[row, best[row]])
                    continue
                # A pair of two minority rows is seen from both sides; one that meets in several slots counts in the first.
                good &= major[1][None, :] | (ids[0][part, None] < ids[1][None, :])
                chunk = (errors <= 1).argmax(axis=2)
                at_first = np.take_along_axis(errors, chunk[:, :, None], axis=2)[:, :, 0]
                good &= (chunk == _CHUNK_OF[slot]) & ((at_first == 1) | _FIRST_OF[slot])
                for row in np.flatnonzero(good.any(axis=1)).tolist():
                    yield key, i, j, 0, int(ids[0][part][row]), int(comps[0][part][row]), ids[1][good[row]].tolist()
                needed |= good.any(axis=0)
            for column in np.flatnonzero(needed).tolist():
                yield key, i, j, 1, int(ids[1][column]), int(comps[1][column]), None

    return arrow_rows(work, NEAREST if nearest else PARTNERS, flush_rows=2000)


def mixed_members(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """`key`, `slot`, `id`, `head`, `comp`, `most`, `n`: members of buckets that hold more than one component.

    `most` is the largest component of the bucket, `n` its number of members.
    """
    known = members.withColumn("comp", F.col("id")) if found is None else skew_safe_join(
        members, found.withColumnRenamed("component", "comp"), ["id"], "left").withColumn("comp", F.coalesce("comp", "id"))
    known = kept(known)
    sizes = known.groupBy("key", "comp").count()
    buckets = sizes.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("largest"), F.count("*").alias("comps"),
                                       F.sum("count").alias("n")).where("comps > 1")
    mixed = kept(skew_safe_join(known, buckets.select("key", F.col("largest.comp").alias("most"), "n"), ["key"]))
    superseded(known)
    return mixed


def apart_pairs(mixed: DataFrame, classes: DataFrame, nearest: bool) -> DataFrame:
    """Bucket mates of different components within the farthest distance: `a`, `b`, or blocks with lists of partners.

    In every bucket, rows outside its largest component are compared with all
    rows: no other pair can be of different components and left out.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mixed = skew_safe_join(mixed.withColumn("blocks", blocks), classes.select("id", "signature"), ["id"]).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("major", F.col("comp") == F.col("most"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = ["slot", "id", "comp", "major", "signature"]
    left = mixed.where("not major").select("key", F.col("own").alias("i"), others.alias("j"), F.lit(0).alias("side"), *names)
    right = mixed.select("key", others.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), *names)
    dealt = left.union(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    if not nearest:
        return dealt.mapInArrow(_block_pairs(False), "key bigint, i int, j int, side int, id bigint, comp bigint, "
                                                     "partners array<bigint>")
    pairs = dealt.mapInArrow(_block_pairs(True), "a bigint, b bigint, distance bigint")
    return pairs.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best")).select("a", "best.b")


def dense_clusters(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """`id`, `comp`, `cluster`, `blocks` of the classes whose cluster is cheaper to compare as a whole than bucket by bucket."""
    inner = components(mixed.select(F.col("id").alias("a"), F.col("head").alias("b"))).select(
        "id", F.col("component").alias("cluster"))
    each = mixed.groupBy("id").agg(F.min("comp").alias("comp"), F.count("*").alias("buckets"))
    # An id has one row in each of the three, so none can be hot.
    named = each.join(inner, ["id"]).join(classes.select("id", "n_shingles"), ["id"])
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / VOLUME)).cast("int")
    sizes = named.groupBy("cluster").agg(blocks.alias("blocks"), F.count("*").alias("n"), F.sum("buckets").alias("dealt"))
    return skew_safe_join(named, sizes.where("blocks * n <= dealt").select("cluster", "blocks"), ["cluster"]).select(
        "id", "comp", "cluster", "blocks")


def compared_in_blocks(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`a`, `b`: links that join the components of each pair of blocks of the clusters.

    A link is given only where none of the same two blocks has joined its components already.
    """

    def work(rows):
        for _, group in groupby(rows, key=lambda row: row[:3]):
            group = list(group)
            data = [np.frombuffer(row[6], np.uint64) for row in group]
            label = np.unique([row[5] for row in group], return_inverse=True)[1]
            sides = [np.flatnonzero([row[3] == side for row in group]) for side in (0, 1)]
            within = group[0][1] == group[0][2]
            left, right = sides[0], sides[0] if within else sides[1]
            if not len(left) or not len(right) or label.max() == 0:
                continue
            sizes = np.array([len(own) for own in data])
            signs = np.stack([signature(own) for own in data])
            # The right side's shingles, sorted, with the rows that have them: one lookup gives the shared shingles with all rows.
            values = np.concatenate([data[row] for row in right])
            owners = np.repeat(np.arange(len(right)), sizes[right])
            order = np.argsort(values, kind="stable")
            values, owners = values[order], owners[order]
            for start in range(0, len(left), 64):
                part = left[start:start + 64]
                errors = _distances(signs[part], signs[right])
                near = (errors.sum(axis=2) <= FARTHEST) & (errors <= 1).any(axis=2)
                for place, row in enumerate(part.tolist()):
                    able = near[place] & (label[right] != label[row])
                    if within:
                        able[:start + place + 1] = False
                    if not able.any():
                        continue
                    low, high = np.searchsorted(values, data[row], "left"), np.searchsorted(values, data[row], "right")
                    counts = high - low
                    found = np.arange(counts.sum()) + np.repeat(low - np.cumsum(counts) + counts, counts)
                    shared = np.bincount(owners[found], minlength=len(right))
                    partners = np.flatnonzero(able & (100 * shared >= percent * (sizes[row] + sizes[right] - shared)))
                    while len(partners):
                        other = right[partners[0]]
                        yield group[row][4], group[other][4]
                        label[label == label[other]] = label[row]
                        partners = partners[label[right[partners]] != label[row]]

    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # One component has nothing to join, and its cluster is not dealt out.
    apart = clusters.groupBy("cluster").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    open_ = skew_safe_join(clusters, apart.select("cluster"), ["cluster"]).withColumn("own", own)
    dealt = open_.select("id", "comp", "cluster", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = skew_safe_join(dealt, sets, ["id"]).select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "comp", "shingles")
    return rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(
        arrow_rows(work, LINKS), "a bigint, b bigint")


def similar_in_blocks(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`a`, `b`: links that join the components of each block, found by comparing partners on full sets.

    Partners whose components a link of the block has joined already are passed over,
    so a block gives fewer links than it has members.
    """

    def work(rows):
        for _, group in groupby(rows, key=lambda row: row[:3]):
            known, parent = {}, {}

            def root(comp):
                while parent.setdefault(comp, comp) != comp:
                    parent[comp] = comp = parent[parent[comp]]
                return comp

            for _, _, _, side, id_, comp, partners, shingles in group:
                own = np.frombuffer(shingles, np.uint64)
                if side:
                    known[id_] = comp, own
                    continue
                for partner in partners:
                    other, theirs = known[partner]
                    if root(comp) != root(other) and alike(own, theirs, percent):
                        parent[root(comp)] = root(other)
                        yield id_, partner

    with_sets = skew_safe_join(blocks, sets, ["id"]).repartition("key", "i", "j").sortWithinPartitions(
        "key", "i", "j", F.desc("side"), "id").select("key", "i", "j", "side", "id", "comp", "partners", "shingles")
    return with_sets.mapInArrow(arrow_rows(work, LINKS), "a bigint, b bigint")


def shingle_sets(documents: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """`id`, `shingles` (sorted 64-bit fingerprints, as bytes) of the classes, each from one of its texts."""

    def work(rows):
        for id_, data in rows:
            yield id_, shingle_set(data, shingle).tobytes()

    texts = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    wanted = classes.select("id", "doc_id", "text_key")
    found = attach(texts, wanted, ["doc_id", "text_key"], F.lit(48), "inner").select("id", "text")
    made = found.mapInArrow(arrow_rows(work, SETS, flush_rows=500), "id bigint, shingles binary")
    # Copies of a row give equal sets.
    return made.dropDuplicates(["id"])


SETS = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])


def alike(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union; sizes alone rule many out."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    places = np.searchsorted(right, left)
    shared = int((right[np.minimum(places, len(right) - 1)] == left).sum())
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs `a`, `b` whose sets are alike."""

    def work(rows):
        for a, b, left, right in rows:
            if alike(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), percent):
                yield a, b

    named = [sets.select(F.col("id").alias(side), F.col("shingles").alias(f"{side}_set")) for side in "ab"]
    both = skew_safe_join(skew_safe_join(pairs, named[0], ["a"]), named[1], ["b"])
    return both.select("a", "b", "a_set", "b_set").mapInArrow(arrow_rows(work, LINKS), "a bigint, b bigint")


def head_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with the bucket head it meets most often, where their signatures are near enough."""
    met = members.where("id <> head").groupBy(F.col("id").alias("a"), F.col("head").alias("b")).count()
    best = met.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))
    signs = [classes.select(F.col("id").alias(side), F.col("signature").alias(f"{side}_sign")) for side in "ab"]
    # A class has one row here, but may be the head of a third of all.
    best = skew_safe_join(best.join(signs[0], ["a"]), signs[1], ["b"])

    def near(rows):
        for a, b, left, right in rows:
            if np.count_nonzero(np.frombuffer(left, np.uint16) != np.frombuffer(right, np.uint16)) <= FARTHEST:
                yield a, b

    return best.select("a", "b", "a_sign", "b_sign").mapInArrow(arrow_rows(near, LINKS), "a bigint, b bigint")


def linked_classes(documents: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """`id`, `component` of the classes that a link joins to others."""
    keyed = classes.select(F.col("id").alias("doc_id"), "signature").mapInArrow(_keys, STRETCH)
    members = kept(shared_stretches(keyed).select(
        "key", F.col("at").cast("int").alias("slot"), F.col("doc_id").alias("id"), F.col("key_first").alias("head")))
    sets = kept(shingle_sets(documents, skew_safe_join(classes, members.select("id").distinct(), ["id"], "left_semi"), shingle))
    links = kept(similar(head_pairs(members, classes), sets, percent))
    mixed = mixed_members(members, components(links))
    dense = kept(dense_clusters(mixed, classes))
    links = kept(links.union(compared_in_blocks(dense, sets, percent)))
    # Clusters are closed under sharing a bucket, so the rest can be compared by itself.
    wide = kept(skew_safe_join(mixed, dense.select("id"), ["id"], "left_anti").select("key", "slot", "id", "head"))
    superseded(members, mixed, dense)
    if not wide.isEmpty():
        for _ in range(2):
            mixed = mixed_members(wide, components(links))
            links = kept(links.union(similar(apart_pairs(mixed, classes, True), sets, percent)))
            superseded(mixed)
        mixed = mixed_members(wide, components(links))
        blocks = kept(apart_pairs(mixed, classes, False))
        links = kept(links.union(similar_in_blocks(blocks, sets, percent)))
        superseded(mixed, blocks)
    joined = components(links)
    superseded(sets, wide, links)
    return joined


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` (smallest doc_id reachable by links), `kept` per row."""
    return row_components(documents, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def row_components(documents: DataFrame, shingle: int, percent: int) -> DataFrame:
    """`near_duplicates` with `text_key` (a hash of the text) and `component`, the number of the row's component."""
    bound_batches(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profile = kept(profiles(documents, shingle))
    # Classes are numbered, as two of them may have rows of the same doc_id.
    classes = kept(profile.where("n_shingles > 0 and doc_id is not null").groupBy("f1", "f2").agg(
        F.min(F.struct("doc_id", "text_key")).alias("least"), F.min("signature").alias("signature"),
        F.min("n_shingles").alias("n_shingles")).select(
        F.monotonically_increasing_id().alias("id"), "f1", "f2", "least.*", "signature", "n_shingles"))
    joined = linked_classes(documents, classes, shingle, percent)
    named = skew_safe_join(classes.select("f1", "f2", "id", "doc_id"), joined, ["id"], "left").select(
        "f1", "f2", "doc_id", F.coalesce("component", "id").alias("component"))
    named = kept(named)
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = skew_safe_join(named.select("f1", "f2", "component"), first, ["component"])
    rows = skew_safe_join(profile.select("doc_id", "text_key", "n_shingles", "f1", "f2"), named, ["f1", "f2"], "left")
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return rows.withColumn("component_id", component_id).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(component_id == F.col("doc_id"), F.lit(False)).alias("kept"),
        "text_key", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")).alias("component"))


def keep_one_each(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """`documents` without near duplicates of kept ones: of each component, one row with its smallest doc_id stays.

    Among rows of that doc_id it is the one with the least hash of the text; of equal rows, one. Rows without doc_id and
    wordless texts stay as they are.
    """
    found = kept(row_components(documents, shingle, percent).where("component is not null"))
    counts = found.groupBy("doc_id", "text_key").agg(
        F.max("component").alias("component"), F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    counts = kept(counts)
    first = counts.where("kept").groupBy("component").agg(F.min("text_key").alias("least"))
    chosen = skew_safe_join(counts, first, ["component"], "left").withColumn(
        "stays", F.coalesce(F.col("kept") & (F.col("text_key") == F.col("least")), F.lit(False)))
    # Documents move only where more than this table can be broadcast: those that go, and those that are there more than once.
    id_, key, stays = unused_names(documents, "id", "key", "stays")
    marked = kept(chosen.where("not stays or n > 1").select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("stays").alias(stays)))
    superseded(found, counts)
    keyed = documents.withColumns({id_: F.col("doc_id").cast("bigint"), key: F.xxhash64("text")})
    joined = attach(keyed, marked, [id_, key], F.lit(40), "left")
    repeated = joined.where(F.col(stays)).dropDuplicates([id_, key])
    return joined.where(F.col(stays).isNull()).select(*documents.columns).union(repeated.select(*documents.columns))
