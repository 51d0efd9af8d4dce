"""Hard negatives by inner product, found with cover trees over norm-augmented vectors.

A vector gets one more component, so that all have the norm of the longest; a query gets a zero. The
distance of the two then falls as their inner product grows, so a node of a metric tree bounds the inner
products of all it covers: with the distance d of a query to its centre and its covering radius r, every
row below lies between d - r and d + r.

The upper level is fitted on a bounded sample: centres in farthest-first order, each the farthest row from
those before, which makes every prefix of them a cover whose members are apart. Every row goes to its
nearest centre; rows are sorted by centre and distance and cut into blocks, and each block is a
cover tree of its own. Queries go to all blocks, in stated sets of a bounded size: a block takes each
query down its levels, leaves out nodes that no window of the query meets, visits the leaf with
the highest bound first and the others as their bounds fall, and scores the rows of a leaf exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixeltally.llm.common import stored
from pixeltally.session import scratch_path

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LEAST_PERCENT, MOST_PERCENT = 50, 95

SAMPLE_ROWS = 4096
CELLS = 256
BLOCK_ROWS = 4096
LEVELS = (1, 8, 64)
QUERY_BYTES = 32 << 20
QUERY_ROWS = 2048
HITS = 1 << 20

VECTORS = "place long, id long, label long, norm2 double, vector binary"
INDEX = "place binary, id binary, label binary, vector binary, leaf binary, parents array<binary>, radii array<binary>"
HIT = "query long, number int, score long, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: single precision where norms keep every sum below
    2**24, double below 2**53, and Python's integers beyond."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    most = np.sqrt(np.einsum("ij,ij->i", a, a).max()) * np.sqrt(np.einsum("ij,ij->i", b, b).max())
    if most < 2 ** 24 - 1:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < 2 ** 53 - 1:
        return a @ b.T
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return whole(a) @ whole(b).T


def _augmented(rows: np.ndarray, norm2: float) -> np.ndarray:
    rest = np.maximum(0.0, norm2 - np.einsum("ij,ij->i", rows, rows))
    return np.hstack([rows, np.sqrt(rest)[:, None]])


def farthest_first(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of up to ``count`` centres, for each point the place of its nearest centre, and its distance.

    Each centre is the point farthest from those before it, beginning with the first point, so those chosen so far
    cover all points within the distance of the next one and are at least that far apart.
    """
    chosen = [0]
    nearest = np.zeros(len(points), np.int64)
    distance = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(count, len(points)):
        far = int(distance.argmax())
        if distance[far] == 0:  # all others are copies of centres
            break
        new = np.linalg.norm(points - points[far], axis=1)
        closer = new < distance
        nearest[closer], distance[closer] = len(chosen), new[closer]
        chosen.append(far)
    return np.array(chosen), nearest, distance


class Tree:
    """A cover tree over the rows of a block.

    ``centres`` are rows; level l has the first ``sizes[l]`` of them. ``parents[l]`` gives for each centre of
    level l its place in level l - 1, ``radii[l]`` how far the rows below it reach. ``leaf`` is the centre of the last level
    that each row belongs to.
    """

    def __init__(self, vectors: np.ndarray, norm2: float, levels: tuple[int, ...] = LEVELS):
        points = _augmented(vectors, norm2)
        self.centres, self.leaf, _ = farthest_first(points, levels[-1])
        self.sizes = sorted({min(size, len(self.centres)) for size in levels})
        self.parents, self.radii = [np.zeros(1, np.int64)], []
        for above, size in zip(self.sizes, self.sizes[1:]):
            gap = np.linalg.norm(points[self.centres[:size], None] - points[None, self.centres[:above]], axis=2)
            self.parents.append(gap.argmin(axis=1))
        at = self.leaf
        for level in reversed(range(len(self.sizes))):
            reach = np.linalg.norm(points - points[self.centres[at]], axis=1)
            radius = np.zeros(self.sizes[level])
            np.maximum.at(radius, at, reach)
            # What rounding could hide, so that a bound never excludes a row that it covers.
            self.radii.insert(0, radius + 1e-6 * np.sqrt(norm2))
            at = self.parents[level][at] if level else at


class TopRows:
    """The best rows of each window: those of the highest scores within its bounds, ties by the smaller id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int):
        self.high, self.keep = high, keep
        self.least, self.least_id = low, np.full(len(low), np.iinfo(np.int64).max)
        self.found = [(np.zeros(0, np.int64), np.zeros(0, low.dtype), np.zeros(0, np.int64))]
        self.waiting = 0

    def add(self, windows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        better = (scores > self.least[windows]) | (ids < self.least_id[windows])
        self.found.append((windows[better], scores[better].astype(self.least.dtype), ids[better]))
        self.waiting += int(better.sum())
        if self.waiting > HITS:
            self.settle()

    def settle(self) -> None:
        """Keep the best of each window, and raise the least score of those that are full."""
        windows, scores, ids = (np.concatenate(parts) for parts in zip(*self.found))
        order = np.lexsort((ids, -scores, windows))
        windows, scores, ids = windows[order], scores[order], ids[order]
        first = np.searchsorted(windows, windows)
        place = np.arange(len(windows)) - first
        kept = place < self.keep
        last = place == self.keep - 1
        self.least[windows[last]], self.least_id[windows[last]] = scores[last], ids[last]
        self.found, self.waiting = [(windows[kept], scores[kept], ids[kept])], 0


class Queries:
    """A bounded set of queries: for each, windows of scores, and whether rows are to have its label or not.

    Window w of query i is number ``i * per_query + w`` of ``top``.
    """

    def __init__(self, place: np.ndarray, label: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, same: bool):
        self.place, self.label, self.vectors, self.same = place, label, vectors, same
        self.per_query = low.shape[1]
        self.norm2 = np.einsum("ij,ij->i", vectors, vectors)
        self.top = TopRows(low.ravel().copy(), high.ravel(), keep)
        self.visited = self.scored = 0

    def search(self, tree: Tree, vectors: np.ndarray, place: np.ndarray, ids: np.ndarray, label: np.ndarray, norm2: float) -> None:
        members = np.split(np.argsort(tree.leaf, kind="stable"), np.cumsum(np.bincount(tree.leaf, minlength=tree.sizes[-1]))[:-1])
        least, high = (x.reshape(-1, self.per_query) for x in (self.top.least, self.top.high))
        for start in range(0, len(self.place), QUERY_ROWS):
            rows = np.arange(start, min(start + QUERY_ROWS, len(self.place)))
            squares = self.norm2[rows, None] + norm2
            distance = np.sqrt(np.maximum(0.0, squares - 2 * _product(self.vectors[rows], vectors[tree.centres]).astype(float)))
            most = high[rows].astype(float).max(axis=1, keepdims=True)
            slack = 1e-9 * squares + 1e-6
            active = np.ones((len(rows), 1), bool)
            for size, parents, radii in zip(tree.sizes, tree.parents, tree.radii):
                upper = (squares - np.maximum(0.0, distance[:, :size] - radii) ** 2) / 2 + slack
                lower = (squares - (distance[:, :size] + radii) ** 2) / 2 - slack
                active = active[:, parents] & (upper >= least[rows].astype(float).min(axis=1, keepdims=True)) & (lower <= most)
            upper = np.where(active, upper, -np.inf)
            # Each query's best leaf first, which raises what the others have to reach.
            best = upper.argmax(axis=1)
            for leaf in np.unique(best):
                self._visit(rows[(best == leaf) & active[:, leaf]], members[leaf], vectors, place, ids, label)
            self.top.settle()
            active[np.arange(len(rows)), best] = False
            for leaf in np.argsort(-upper.max(axis=0), kind="stable"):
                wanted = active[:, leaf] & (upper[:, leaf] >= least[rows].astype(float).min(axis=1))
                if wanted.any():
                    self._visit(rows[wanted], members[leaf], vectors, place, ids, label)
            self.top.settle()

    def _visit(self, queries: np.ndarray, members: np.ndarray, vectors: np.ndarray, place: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        self.visited += len(queries)
        self.scored += len(queries) * len(members)
        scores = _product(self.vectors[queries], vectors[members])
        fits = (self.label[queries, None] == label[None, members]) == self.same
        if self.same:
            fits &= self.place[queries, None] != place[None, members]
        for w in range(self.per_query):
            windows = queries * self.per_query + w
            here = fits & (scores >= self.top.least[windows, None]) & (scores <= self.top.high[windows, None])
            row, column = np.nonzero(here)
            self.top.add(windows[row], scores[row, column], ids[members[column]])

    def hits(self) -> Iterator[pa.RecordBatch]:
        """Windows and their best rows."""
        self.top.settle()
        windows, scores, ids = self.top.found[0]
        for at in range(0, len(windows), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(windows[part] // self.per_query), pa.array((windows[part] % self.per_query).astype(np.int32)),
                pa.array([int(s) for s in scores[part]], pa.int64()), pa.array(ids[part])], names=["query", "number", "score", "id"])


def _matrix(rows: pa.Array, dims: int) -> np.ndarray:
    values = rows.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), dims)


def packed_vectors(rows: DataFrame, vector: str, label: str, row_id: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """The rows that take part with their scaled vectors as bytes, stored, and the number of components."""
    finite = F.forall(F.col("vector"), lambda x: F.abs(x) < float("inf"))
    clean = rows.select(F.col(row_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    clean = clean.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    dims = clean.agg(F.max(F.size("vector"))).first()[0]
    if not dims:
        dims = 1  # no rows, or empty vectors only

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            lengths = np.diff(column.offsets.to_numpy())
            vectors = np.zeros((len(lengths), dims))
            vectors[np.arange(dims) < lengths[:, None]] = np.floor(scale * column.flatten().to_numpy())
            yield pa.RecordBatch.from_arrays([
                *[batch.column(k) for k in range(3)], pa.array(np.einsum("ij,ij->i", vectors, vectors)),
                pa.array([v.tobytes() for v in vectors], pa.binary())], names=["place", "id", "label", "norm2", "vector"])

    placed = clean.select(F.monotonically_increasing_id().alias("place"), "id", "label", "vector")
    return stored(placed.mapInArrow(pack, VECTORS), "vectors"), dims


def build_index(vectors: DataFrame, dims: int, norm2: float) -> DataFrame:
    """All rows, in blocks of at most ``BLOCK_ROWS``: one row per block, with its cover tree. Stored."""
    sample = vectors.orderBy(F.xxhash64("place")).limit(SAMPLE_ROWS).select("vector").toArrow()["vector"]
    points = _augmented(_matrix(sample, dims), norm2)
    centres = points[farthest_first(points, CELLS)[0]]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _augmented(_matrix(batch.column(4), dims), norm2)
            squares = np.einsum("ij,ij->i", centres, centres) - 2 * points @ centres.T
            distance = np.sqrt(np.maximum(0.0, squares.min(axis=1) + np.einsum("ij,ij->i", points, points)))
            columns = [*batch.columns, pa.array(squares.argmin(axis=1)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "distance"])

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        matrix = _matrix(table["vector"], dims)
        tree = Tree(matrix, norm2)
        as_bytes = lambda arrays: [np.ascontiguousarray(a).tobytes() for a in arrays]
        flat = as_bytes([*[table[c].to_numpy() for c in ("place", "id", "label")], matrix, np.append(tree.centres, tree.leaf)])
        return pa.RecordBatch.from_arrays(
            [*[pa.array([x], pa.binary()) for x in flat], *[pa.array([as_bytes(x)], pa.list_(pa.binary())) for x in (tree.parents, tree.radii)]],
            names=["place", "id", "label", "vector", "leaf", "parents", "radii"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, BLOCK_ROWS - count)
                held.append(part)
                count += len(part)
                batch = batch.slice(len(part))
                if count == BLOCK_ROWS:
                    yield block(held)
                    held, count = [], 0
        if held:
            yield block(held)

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["cell", "distance", "place"]
    routed = stored(vectors.mapInArrow(route, f"{VECTORS}, cell long, distance double"), "routed")
    return stored(routed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, INDEX), "index")


class _Stored(Tree):
    """A tree read from a row of the index."""

    def __init__(self, leaf: np.ndarray, rows: int, parents: list[bytes], radii: list[bytes]):
        self.centres, self.leaf = leaf[:-rows], leaf[-rows:]
        self.parents = [np.frombuffer(p, np.int64) for p in parents]
        self.radii = [np.frombuffer(r, np.float64) for r in radii]
        self.sizes = [len(r) for r in self.radii]


def _searched(index: DataFrame, dims: int, norm2: float, queries: Callable[[], Queries], name: str) -> DataFrame:
    """The best rows of each window over all blocks: ``query, number, score, id, rank``. Stored."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = queries()
        for batch in batches:
            for place, ids, label, vector, leaf, parents, radii in zip(*[column.to_pylist() for column in batch.columns]):
                place, ids, label, leaf = (np.frombuffer(x, np.int64) for x in (place, ids, label, leaf))
                vectors = np.frombuffer(vector, np.float64).reshape(len(place), dims)
                asked.search(_Stored(leaf, len(place), parents, radii), vectors, place, ids, label, norm2)
        yield from asked.hits()

    best = Window.partitionBy("query", "number").orderBy(F.desc("score"), "id")
    hits = index.mapInArrow(search, HIT).withColumn("rank", F.row_number().over(best))
    return stored(hits.filter(F.col("rank") <= queries().top.keep), name)


def _of(values: list[list[int]], exact: bool) -> np.ndarray:
    return np.array(values, float if exact else object)


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT,
         most_percent: int = MOST_PERCENT, scale: int = SCALE, vector: str = "embedding", label: str = "label", row_id: str = "vec_id",
         query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components are scaled and floored, and scores are the exact inner products of what that gives. Anchors are the
    rows whose id is divisible by ``every``; an anchor's positives are the ``positives`` other rows of its label with the
    highest scores; for each, the ``negatives`` rows of other labels with the highest scores between the two
    percentages of the positive's are returned, ranked from 1. Ties go to the smaller id. A positive with a negative
    score has an empty window.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Shorter vectors count as
    ended by zeros; an empty vector scores 0. Rows that repeat an id are rows of their own, each an
    anchor where the id is one, and each a positive of the other. Equal rows can all be returned. Other columns
    are ignored; an empty table gives no rows. A score beyond 64 bits is an error.

    Anchors are asked in sets of about ``query_bytes`` dealt out by hash, one after another: only one set
    with its windows is at the driver and broadcast at a time, whatever the number of rows is. A task holds one block
    and one set, and returns the best rows of each window. The table is indexed once.
    """
    spark = rows.sparkSession
    table, dims = packed_vectors(rows, vector, label, row_id, scale)
    norm2 = table.agg(F.max("norm2")).first()[0]
    if norm2 is None:
        return spark.createDataFrame([], RESULT)
    index = build_index(table, dims, norm2)
    anchors = table.filter(F.col("id") % every == 0)
    sets = max(1, -(-anchors.count() * 8 * (dims + 6 * positives) // query_bytes))
    exact = norm2 < 2 ** 53 - 1  # else thresholds are Python's integers
    path = scratch_path(spark, "mined")
    for number in range(sets):
        asked = anchors.filter(F.pmod(F.xxhash64("place"), F.lit(sets)) == number).select("place", "id", "label", "vector").toArrow()
        place, ids, labels = (asked[c].to_numpy() for c in ("place", "id", "label"))
        shared = spark.sparkContext.broadcast((place, labels, _matrix(asked["vector"], dims)))

        def nearest() -> Queries:
            n = len(shared.value[0])
            bounds = [_of([[x]] * n, exact).reshape(n, 1) for x in (-np.inf, np.inf)]
            return Queries(*shared.value, *bounds, positives, same=True)

        found = _searched(index, dims, norm2, nearest, "positives").toArrow()
        score = np.full((len(ids), positives), None, object)
        score[found["query"].to_numpy(), found["rank"].to_numpy() - 1] = found["score"].to_pylist()
        # A window without a positive, or whose bounds cross, takes nothing.
        low = [[np.inf if s is None else -(-least_percent * s // 100) for s in row] for row in score]
        high = [[-np.inf if s is None else most_percent * s // 100 for s in row] for row in score]
        windows = spark.sparkContext.broadcast((low, high))

        def between() -> Queries:
            n = len(shared.value[0])
            bounds = [_of(x, exact).reshape(n, positives) for x in windows.value]
            return Queries(*shared.value, *bounds, negatives, same=False)

        taken = _searched(index, dims, norm2, between, "negatives")
        named = spark.createDataFrame(pa.table({
            "query": found["query"], "number": pa.array(found["rank"].to_numpy() - 1, pa.int32()),
            "anchor_id": pa.array(ids[found["query"].to_numpy()], pa.int64()), "positive_id": found["id"], "positive_score": found["score"]}))
        named.join(taken.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}), ["query", "number"]).select(
            *[part.split()[0] for part in RESULT.split(", ")]).write.mode("append").parquet(path)
        shared.destroy()
        windows.destroy()
    return spark.read.schema(RESULT).parquet(path)
