"""Approximate nearest neighbours by a forest of random-projection trees.

Largest inner product is made a Euclidean search by one more coordinate (what a vector's square
lacks to the largest square). Each tree halves a bounded sample along the line between two
random groups of it, down to leaves; then every row is put into its leaf of every tree. A query goes
through all trees with one shared priority queue, ordered by the worst margin on the way to a
node, and collects leaves until they hold enough rows. Rows and queries then meet by leaf; a leaf
scores its rows exactly, in double precision, and hands on each query's best ones only.

Equal vectors are one point: of its rows only the k + 1 of smallest id can be in any answer, so
only those are indexed, and queries with equal vectors are searched once. Leaves are cut into
cells of bounded size, however many rows they get.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite components take no part,
nor do those of another length than the commonest (the longer one of two); rows with a null id
take no part; of rows with equal id and vector one is used; without queries or candidates the result is
empty. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.materialize import settle

NEIGHBOURS = 20
SAMPLE_ROWS = 20_000
TREES = 8
LEAVES = 64
# Rows that the collected leaves must hold, counted in every tree, as a share of all. Vectors
# without any cluster structure need this much for a recall above 0.9; clustered ones need less.
SEARCH_SHARE = 1.2
CELL_ROWS, CELL_QUERIES = 2_048, 32_768


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


@dataclass
class Forest:
    """Complete binary trees; node i of a tree has children 2i+1 and 2i+2."""

    largest: float  # largest square of a sampled vector
    normals: np.ndarray  # tree, node, coordinate
    offsets: np.ndarray  # tree, node
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, trees: int, depth: int, seed: int = 11) -> Forest:
        largest = float((sample**2).sum(axis=1).max(initial=0.0))
        forest = cls(largest, np.zeros((trees, 2**depth - 1, sample.shape[1] + 1)), np.zeros((trees, 2**depth - 1)), depth)
        points, random = forest.lifted(sample), np.random.default_rng(seed)
        for tree in range(trees):
            forest._split(tree, 0, points, random)
        return forest

    def _split(self, tree: int, node: int, points: np.ndarray, random) -> None:
        if node >= self.offsets.shape[1] or len(points) < 2:
            return
        some = points[random.choice(len(points), min(len(points), 64), replace=False)]
        normal = some[: len(some) // 2].mean(axis=0) - some[len(some) // 2 :].mean(axis=0)
        pair = some[0] - some[-1]
        for _ in range(4):  # two means
            near = some @ pair > np.median(some @ pair)
            if near.all() or not near.any():
                break
            normal = pair = some[near].mean(axis=0) - some[~near].mean(axis=0)
        size = np.linalg.norm(normal)
        normal = normal / size if size > 0 else normal
        along = points @ normal
        offset = float(np.median(along))
        self.normals[tree, node], self.offsets[tree, node] = normal, offset
        self._split(tree, 2 * node + 1, points[along <= offset], random)
        self._split(tree, 2 * node + 2, points[along > offset], random)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        lack = np.sqrt(np.maximum(self.largest - (rows**2).sum(axis=1), 0.0))
        return np.column_stack([rows, lack])

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree (row, tree)."""
        points = self.lifted(rows)
        found = np.zeros((len(points), len(self.offsets)), np.int64)
        for tree in range(len(self.offsets)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                margin = np.einsum("ij,ij->i", points, self.normals[tree, node]) - self.offsets[tree, node]
                node = 2 * node + 1 + (margin > 0)
            found[:, tree] = node - self.offsets.shape[1]
        return found

    def search(self, query: np.ndarray, sizes: dict[tuple[int, int], int], enough: int) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) that hold rows, best first, until they hold ``enough`` rows."""
        point = np.append(query, 0.0)  # a query has no lack: only the order of products counts
        inner = self.offsets.shape[1]
        margins = self.normals @ point - self.offsets
        queue = [(-np.inf, tree, 0) for tree in range(len(self.offsets))]
        found, rows = [], 0
        while queue and rows < enough:
            worst, tree, node = heapq.heappop(queue)
            while node < inner:
                margin = margins[tree, node]
                heapq.heappush(queue, (max(worst, abs(margin)), tree, 2 * node + 1 + (margin <= 0)))
                node = 2 * node + 1 + (margin > 0)
            if n := sizes.get((tree, node - inner), 0):
                found.append((tree, node - inner))
                rows += n
        return found


def _points(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v, point): usable rows, each once; point is equal just for equal vectors."""
    rows = vectors.filter(usable(F.col(vector)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")
    )
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    text = F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))  # -0.0 is 0.0
    return rows.filter(F.size("v") == (common.n if common else 0)).withColumn(
        "point", F.sha2(F.array_join(text, ","), 256)
    ).dropDuplicates(["id", "point"])


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of each query: position, id and product of the ``keep`` largest products, ties to small ids."""
    found = []
    for s in range(0, len(queries), 64):
        # Not a matrix product: its sums may depend on what else is in the batch.
        products = np.einsum("ik,jk->ij", queries[s : s + 64], rows)
        low = np.partition(products, -keep, axis=1)[:, -keep, None] if len(rows) > keep else -np.inf
        at, column = np.nonzero(products >= low)
        value = products[at, column]
        order = np.lexsort((ids[column], -value, at))
        at, column, value = at[order], column[order], value[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        at, column, value = (x[place < keep] for x in (at, column, value))
        found.append((s + at, ids[column], value))
    return tuple(map(np.concatenate, zip(*found)))


def nearest(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
    is_query: Column | None = None, k: int = NEIGHBOURS, trees: int = TREES, leaves: int = LEAVES,
    search_share: float = SEARCH_SHARE, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of largest inner product found.

    ``is_query`` is a condition on ``id``, by default that it is divisible by 20. The trees are
    fitted on ``sample_rows`` rows at most; every row is indexed.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    asked = F.col("id") % 20 == 0 if is_query is None else is_query
    points = settle(_points(vectors, id_column, vector))
    numbered = points.withColumn(
        "_n", F.row_number().over(Window.partitionBy("point").orderBy("id"))
    )
    indexed = settle(numbered.filter(F.col("_n") <= k + 1).select("id", "v"))
    questions = settle(points.filter(asked).select("id", "point").distinct())
    searched = settle(points.filter(asked).groupBy("point").agg(F.first("v").alias("v")))
    total, asks = indexed.count(), searched.count()
    if not asks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = indexed.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()
    matrix = np.array([r.v for r in sample], float)
    dim = matrix.shape[1]
    depth = min(leaves.bit_length() - 1, max(0, (len(matrix) // 8).bit_length() - 1))
    forest = context.broadcast(Forest.fit(matrix, trees, depth))
    kind = indexed.schema["v"].dataType.simpleString()

    def placed(sizes):
        """Every row in its leaf of every tree; with ``sizes``, also in a cell of the leaf."""

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, len(batch), 1_024):
                    some = batch.slice(s, 1_024)
                    leaf = forest.value.leaves(_matrix(some.column(1), dim))
                    n, width = leaf.shape
                    row, tree, leaf = np.repeat(np.arange(n), width), np.tile(np.arange(width), n), leaf.ravel()
                    cells = np.ones(len(row), np.int64)
                    if sizes is not None:
                        held = [sizes.value[key] for key in zip(tree.tolist(), leaf.tolist())]
                        cells = -(-np.array(held, np.int64) // CELL_ROWS)
                    id_hash = some.column(0).to_numpy()[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    cell = (id_hash >> np.uint64(20)).astype(np.int64) % cells
                    yield pa.record_batch(
                        [some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), pa.array(tree), pa.array(leaf), pa.array(cell)],
                        names=["id", "v", "tree", "leaf", "cell"],
                    )

        return indexed.select("id", "v").mapInArrow(place, f"id long, v {kind}, tree long, leaf long, cell long")

    # One number per leaf.
    counts = placed(None).groupBy("tree", "leaf").count().collect()
    sizes = context.broadcast({(r["tree"], r["leaf"]): r["count"] for r in counts})
    enough = search_share * total

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 256):
                some = batch.slice(s, 256)
                rows = []
                for i, query in enumerate(_matrix(some.column(1), dim)):
                    for t, f in forest.value.search(query, sizes.value, enough):
                        rows += ((i, t, f, c) for c in range(-(-sizes.value[t, f] // CELL_ROWS)))
                row, tree, leaf, cell = np.array(rows, np.int64).reshape(-1, 4).T
                yield pa.record_batch(
                    [some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), *map(pa.array, (tree, leaf, cell))],
                    names=["point", "v", "tree", "leaf", "cell"],
                )

    parts = -(-asks // CELL_QUERIES)
    asking = searched.mapInArrow(ask, f"point string, v {kind}, tree long, leaf long, cell long").select(
        "point", F.lit(None).cast("long").alias("id"), "v", "tree", "leaf", "cell",
        F.pmod(F.xxhash64("point"), F.lit(parts)).cast("int").alias("part"),
    )
    members = placed(sizes).select(
        F.lit(None).cast("string").alias("point"), "id", "v", "tree", "leaf", "cell",
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )

    def score(cell):
        rows, queries = cell.filter(cell["id"].is_valid()), cell.filter(cell["point"].is_valid())
        at, near, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(rows) and len(queries):
            vectors = [_matrix(x["v"].combine_chunks(), dim) for x in (queries, rows)]
            at, near, value = _best(*vectors, rows["id"].to_numpy(), k + 1)
        asked_by = queries["point"].combine_chunks().take(pa.array(at))
        return pa.table({"point": asked_by, "id": pa.array(near), "score": pa.array(value)})

    scored = (
        asking.unionAll(members)
        .groupBy("tree", "leaf", "cell", "part")
        .applyInArrow(score, "point string, id long, score double")
    )
    best = Window.partitionBy("point").orderBy(F.desc("score"), "id")
    answers = settle(
        scored.groupBy("point", "id").agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        questions.select(F.col("id").alias("query_id"), "point").join(answers, "point")
        .filter(F.col("query_id") != F.col("id"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
