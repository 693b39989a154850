"""Near duplicates of embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors of one label are compared by cosine in double precision; on unit vectors that is a distance
bound. Equal vectors are one tree point with a weight. The top of a label's tree is a set of
centers, chosen from a bounded sample; every vector belongs to the cell of its nearest center,
and visits an earlier cell only if it lies within the distance bound of the plane between the two centers: no
pair closer than the bound is parted. A large label gets more centers: they are chosen for the sizes that the label has,
not for those of its sample. Cells are dealt out in blocks of about `BLOCK` vectors; each pair of blocks that hold
a cell's own vectors meets once, and so does each such block with each block of the cell's visitors. Vectors travel
in the type they came in and become unit vectors where they are compared. A task builds the lower levels, whose radii halve, and walks two trees at once:
node pairs too far apart by their covering radii are dropped, node pairs that are near enough as a
whole are counted as a whole, the rest is compared point by point. A task returns each vector's
count and one link to its component within the block, never all pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors without label,
link with nothing; so do vectors of different lengths. Repeated rows are one vector; other vectors with equal
components link. Rows without vec_id keep null results. An empty table gives an
empty result; columns other than vec_id, embedding and label are ignored.
"""

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, attach, components, kept, superseded
from crawlspark.operators.joins import skew_safe_join

BLOCK = 2048
LEAF = 48
CENTERS, MOST_CENTERS = 64, 512
SAMPLE = 20_000
#: Node bounds are rounded outwards by this much; point pairs are compared exactly.
SLACK = 1e-6


class Node:
    """A range of the tree's points within `radius` of its center."""

    __slots__ = ("start", "end", "center", "radius", "children", "centers", "radii")

    def __init__(self, start: int, end: int, center: np.ndarray, radius: float):
        self.start, self.end, self.center, self.radius, self.children = start, end, center, radius, []


class CoverTree:
    """Nested levels over unit vectors: a node's children are centers more than half its radius apart."""

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.order = np.arange(len(points))
        self.source, self.source_weights = points, weights
        self.root = self._build(0, len(points), points[0], 2.0)
        self.points, self.weights = points[self.order], weights[self.order]
        self.sums = np.r_[0, np.cumsum(self.weights)]

    def _build(self, start: int, end: int, center: np.ndarray, radius: float) -> Node:
        own = self.source[self.order[start:end]]
        node = Node(start, end, center, float(np.linalg.norm(own - center, axis=1).max()))
        if end - start <= LEAF or node.radius < 1e-9:
            return node
        half = min(radius, node.radius) / 2
        owner, centers, left = np.full(len(own), -1), [], np.arange(len(own))
        # Unit vectors: within `half` of each other means a dot product of at least 1 - half^2 / 2.
        alike = own @ own.T >= 1 - half * half / 2
        while len(left):
            chosen = left[0]
            near = alike[chosen, left]
            near[0] = True
            owner[left[near]] = len(centers)
            centers.append(chosen)
            left = left[~near]
        order = np.argsort(owner, kind="stable")
        self.order[start:end] = self.order[start:end][order]
        bounds = start + np.searchsorted(owner[order], np.arange(len(centers) + 1))
        node.children = [self._build(int(a), int(b), own[c], half) for a, b, c in zip(bounds, bounds[1:], centers)]
        node.centers = np.array([child.center for child in node.children])
        node.radii = np.array([child.radius for child in node.children])
        return node


class Links:
    """Counts per point and components over the points of two trees."""

    def __init__(self, left: CoverTree, right: CoverTree, least: float):
        self.left, self.right, self.least = left, right, least
        self.bound = float(np.sqrt(max(0.0, 2 - 2 * least)))
        self.counts = [np.zeros(len(left.points), np.int64), np.zeros(len(right.points), np.int64)]
        self.shift = len(left.points)
        self.parent = list(range(self.shift + len(right.points)))

    def root(self, place: int) -> int:
        parent = self.parent
        while parent[place] != place:
            parent[place] = place = parent[parent[place]]
        return place

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def walk(self) -> None:
        waiting = [(self.left.root, self.right.root)]
        while waiting:
            a, b = waiting.pop()
            apart = float(np.linalg.norm(a.center - b.center))
            if apart > a.radius + b.radius + self.bound + SLACK:
                continue
            if apart + a.radius + b.radius < self.bound - SLACK:
                self._whole(a, b)
            elif not a.children and not b.children:
                self._points(a.start, a.end, b.start, b.end)
            elif a.children and b.children:
                # All child pairs at once; only near ones are visited.
                apart = np.sqrt(np.maximum(0, 2 - 2 * (a.centers @ b.centers.T)))
                apart -= self.bound + SLACK
                apart -= a.radii[:, None]
                near = np.nonzero(apart <= b.radii[None, :])
                waiting += [(a.children[row], b.children[column]) for row, column in zip(*[n.tolist() for n in near])]
            elif a.children:
                apart = np.linalg.norm(a.centers - b.center, axis=1)
                near = np.flatnonzero(apart <= a.radii + b.radius + self.bound + SLACK)
                waiting += [(a.children[place], b) for place in near.tolist()]
            else:
                apart = np.linalg.norm(b.centers - a.center, axis=1)
                near = np.flatnonzero(apart <= b.radii + a.radius + self.bound + SLACK)
                waiting += [(a, b.children[place]) for place in near.tolist()]

    def _whole(self, a: Node, b: Node) -> None:
        self.counts[0][a.start:a.end] += self.right.sums[b.end] - self.right.sums[b.start]
        self.counts[1][b.start:b.end] += self.left.sums[a.end] - self.left.sums[a.start]
        for place in range(a.start, a.end):
            self.join(place, self.shift + b.start)
        for place in range(b.start, b.end):
            self.join(a.start, self.shift + place)

    def _points(self, a: int, a_end: int, b: int, b_end: int) -> None:
        links = self.left.points[a:a_end] @ self.right.points[b:b_end].T >= self.least
        if not links.any():
            return
        self.counts[0][a:a_end] += links @ self.right.weights[b:b_end]
        self.counts[1][b:b_end] += self.left.weights[a:a_end] @ links
        for row, column in zip(*[places.tolist() for places in np.nonzero(links)]):
            self.join(a + row, self.shift + b + column)


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """`vec_id`, `label`, `vector` (float components as they are, others as double) of rows that can link at all."""
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.where("vec_id is not null and label is not null and embedding is not null").where(
        F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), vector.alias("vector"))


def unit(rows: list) -> np.ndarray:
    points = np.array(rows, np.float64)
    points /= np.abs(points).max(axis=1, keepdims=True)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def label_centers(points: DataFrame, bound: float, sample: int = SAMPLE) -> dict:
    """(label, length) to centers: the top of each label's tree, from at most about `sample` vectors in all.

    Of a label's centers, picked farthest first, as many are used as make the fewest comparisons of
    all its vectors, as the sampled ones tell: vectors that do not cluster are best left in one cell.
    """
    total = points.count()
    share = min(1.0, sample / max(1, total))
    drawn = points.where(F.pmod(F.xxhash64("id", F.lit("centers")), F.lit(1 << 20)) < share * (1 << 20))
    by_label: dict = {}
    for row in sorted(drawn.select("id", "label", "vector").limit(2 * sample).collect()):
        by_label.setdefault((row["label"], len(row["vector"])), []).append(row["vector"])
    return {label: _top(unit(rows), bound, 1 / share) for label, rows in by_label.items()}


def _top(own: np.ndarray, bound: float, scale: float) -> np.ndarray:
    """Centers for a label that has `scale` times the vectors of `own`."""
    most = min(MOST_CENTERS, int(CENTERS * np.ceil(np.sqrt(scale))), len(own))
    chosen, apart = [own[0]], np.linalg.norm(own - own[0], axis=1)
    while len(chosen) < most and apart.max() > bound:
        chosen.append(own[int(apart.argmax())])
        apart = np.minimum(apart, np.linalg.norm(own - chosen[-1], axis=1))
    chosen, costs = np.array(chosen), {}
    for count in {1, *(2 ** power for power in range(1, 12) if 2 ** power < len(chosen)), len(chosen)}:
        homes, visitors = np.zeros(count), np.zeros(count)
        for start in range(0, len(own), 1024):
            cell, visits = _places(own[start:start + 1024], chosen[:count], bound)
            homes += np.bincount(cell, minlength=count)
            visitors += visits.sum(axis=0)
        # A vector copied to another cell costs about as much as 64 comparisons; comparisons grow with the square of the scale.
        costs[count] = scale * float((homes * (homes / 2 + visitors)).sum()) + 64 * float(visitors.sum())
    return chosen[:min(costs, key=lambda count: (costs[count], count))]


def _places(own: np.ndarray, centers: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cell, and which earlier cells it visits."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * own @ centers.T))
    cell = apart.argmin(axis=1)
    between = np.sqrt(np.maximum(1e-12, 2 - 2 * centers @ centers.T))[cell]
    beyond = (apart ** 2 - apart[np.arange(len(own)), cell][:, None] ** 2) / (2 * between)
    return cell, (beyond <= bound) & (np.arange(len(centers))[None, :] < cell[:, None])


def cells(points: DataFrame, centers: dict, bound: float) -> DataFrame:
    """`label`, `size`, `cell`, `home`, `id`, `weight`, `vector`: each vector in its own cell and in those it visits."""
    table = points.sparkSession.sparkContext.broadcast(centers)
    kind = points.schema["vector"].dataType.elementType.simpleString()

    def work(rows):
        for id_, label, weight, vector in rows:
            key, cell = (label.decode(), len(vector)), 0
            known = table.value.get(key)
            if known is not None:
                cells_, visits = _places(unit([vector]), known, bound)
                cell = int(cells_[0])
                for visited in np.flatnonzero(visits[0]).tolist():
                    yield key[0], len(vector), visited, False, id_, weight, vector
            yield key[0], len(vector), cell, True, id_, weight, vector

    schema = pa.schema([("label", pa.string()), ("size", pa.int32()), ("cell", pa.int32()), ("home", pa.bool_()),
                        ("id", pa.int64()), ("weight", pa.int64()),
                        ("vector", pa.list_(pa.float32() if kind == "float" else pa.float64()))])
    return points.select("id", "label", "weight", "vector").mapInArrow(
        arrow_rows(work, schema, flush_rows=4096),
        f"label string, size int, cell int, home boolean, id bigint, weight bigint, vector array<{kind}>")


def block_pairs(placed: DataFrame) -> DataFrame:
    """The rows of `cells`, dealt out to pairs of blocks `i`, `j` of their cell: `side` 0 belongs to `i`, `side` 1 to `j`.

    Blocks of the cell's own vectors are numbered first and meet once (`i` <= `j`); a block that meets itself is sent
    once. Blocks of visitors follow and meet every block of the cell's own. Cells that only have visitors drop out.
    """
    keys = ["label", "size", "cell"]
    blocks = lambda home: F.ceil(F.count_if(F.col("home") == home) / BLOCK).cast("int")
    sizes = placed.groupBy(*keys).agg(blocks(True).alias("own"), blocks(False).alias("visiting")).where("own > 0")
    known = attach(placed, sizes, keys, F.lit(64), "inner").withColumn("block", F.when(
        F.col("home"), F.pmod(F.xxhash64("id"), F.col("own"))).otherwise(
        F.col("own") + F.pmod(F.xxhash64("id"), F.col("visiting"))).cast("int"))
    columns = ["id", "weight", "vector", "home"]
    left = known.where("home").select(
        *keys, F.col("block").alias("i"), F.explode(F.sequence("block", F.col("own") + F.col("visiting") - 1)).alias("j"),
        F.lit(0).alias("side"), *columns)
    right = known.where("block > 0").select(
        *keys, F.explode(F.sequence(F.lit(0), F.least("block", "own") - 1)).alias("i"), F.col("block").alias("j"),
        F.lit(1).alias("side"), *columns)
    return left.union(right).repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _walk_blocks(least: float):
    def tree_of(side: list) -> tuple[CoverTree, np.ndarray]:
        tree = CoverTree(unit([row[8] for row in side]), np.array([row[7] for row in side], np.int64))
        return tree, np.array([row[6] for row in side])[tree.order]

    def work(rows):
        for (_, _, _, i, j), group in groupby(rows, key=lambda row: row[:5]):
            group = list(group)
            sides = [[row for row in group if row[5] == side] for side in (0, 1)]
            if not sides[0] or i != j and not sides[1]:
                continue
            # Within one block every pair is seen twice, and each vector meets itself: only the left side counts.
            left, ids = tree_of(sides[0])
            right, other_ids = (left, ids) if i == j else tree_of(sides[1])
            links = Links(left, right, least)
            links.walk()
            every = np.concatenate([ids, other_ids])
            for side in range(1 if i == j else 2):
                base = side * links.shift
                for place in np.flatnonzero(links.counts[side]).tolist():
                    yield int(every[base + place]), int(links.counts[side][place]), int(every[links.root(base + place)])

    return arrow_rows(work, pa.schema([("id", pa.int64()), ("n", pa.int64()), ("link", pa.int64())]))


def linked_vectors(embeddings: DataFrame, least: float = 0.93) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` per row: links at cosine >= `least` within a label."""
    usable = usable_vectors(embeddings).withColumns({
        "key": F.xxhash64("label", "vector"), "key_2": F.xxhash64("label", "vector", F.lit("second"))})
    # Equal vectors of a label are told by two 64-bit hashes, so that only one of each travels, and only to be compared.
    keys = ["key", "key_2"]
    rows = kept(usable.select("vec_id", *keys).distinct())
    weights = rows.groupBy(*keys).agg(F.count("*").alias("weight"), F.min("vec_id").alias("id"))
    points = kept(skew_safe_join(usable.groupBy(*keys).agg(
        F.first("label").alias("label"), F.first("vector").alias("vector")), weights, keys))
    bound = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
    placed = kept(cells(points, label_centers(points, bound), bound))
    found = kept(block_pairs(placed).mapInArrow(_walk_blocks(least), "id bigint, n bigint, link bigint"))
    superseded(placed)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("id").alias("a"), F.col("link").alias("b")))
    known = skew_safe_join(points.select("id", *keys), counts, ["id"], "left")
    known = skew_safe_join(known, joined, ["id"], "left").select(*keys, "n", F.coalesce("component", "id").alias("component"))
    per_vector = skew_safe_join(rows, known, keys).groupBy("vec_id").agg(
        F.sum(F.col("n") - 1).alias("n"), F.min("component").alias("component"))
    vec_id = F.col("vec_id").cast("bigint")
    result = skew_safe_join(embeddings.select(vec_id.alias("vec_id")), per_vector, ["vec_id"], "left")
    component = F.coalesce("component", "vec_id")
    return result.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
