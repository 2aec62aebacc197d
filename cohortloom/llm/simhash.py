"""SimHash near-duplicates by vantage-point trees, exact at a given Hamming radius.

Distinct fingerprints are the points. A vantage-point tree fitted on a bounded sample cuts
Hamming space into shards: at each node a point goes left if its distance to the vantage
point is within the node's median distance. Every fingerprint belongs to one home shard and
also queries each shard that its ball overlaps by the triangle bound, so no pair is missed
whatever the sample was. Within a shard the search goes on in the same way: distances to one
more vantage point rule out all points whose distance differs by more than the radius.

A shard never returns its pairs, only a spanning star per group it finds, so large groups of
near copies stay linear; shards are cut into cells of bounded size, and equal fingerprints
count once. The groups of all cells are joined by distributed connected components.

Defined cases: null, empty or blank texts have fingerprint 0 and are linked like any other;
documents with a null id take part and get their group's smallest non-null id, null if there
is none; repeated rows give repeated result rows; a long text is hashed whole, and its bits are
counted a bounded number of shingles at a time; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import modest_batches
from cohortloom.llm.components import connected_components
from cohortloom.operators.index import first_event
from cohortloom.operators.materialize import settle

SHINGLE = 4
RADIUS = 4
SAMPLE = 16_384  # fingerprints that the tree is fitted on, at most
MEMBERS, QUERIES = 8_192, 65_536  # a cell has so many of each, at most by expectation


def fingerprint(text: str | None) -> int:
    """64 majority bits over XXH64 (seed 42) of 4-word shingles, as a signed integer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s : e - 1], 42) for s, e in zip(starts, starts[SHINGLE:])]
    packed = np.array(hashes, np.uint64).view(np.uint8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(packed), 1 << 18):  # bounded, however long the text is
        bits = np.unpackbits(packed[at : at + (1 << 18)], bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) of every row."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(map(fingerprint, texts)), dtype="int64")

    modest_batches(docs.sparkSession)
    return docs.select(
        F.col(id_column).alias("id"), F.pandas_udf(of, "long")(F.col(text)).alias("fp")
    )


class VantageTree:
    """A complete binary tree over Hamming space; node i has children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.points = np.zeros(2**depth - 1, np.uint64)
        self.cuts = np.full(2**depth - 1, 64, np.int64)
        self._split(0, sample)

    def _split(self, node: int, sample: np.ndarray) -> None:
        if node >= len(self.points) or not len(sample):
            return
        spread = [np.bitwise_count(sample ^ v).astype(np.int64) for v in sample[:12]]
        best = max(range(len(spread)), key=lambda i: spread[i].std())
        cut = int(np.median(spread[best]))
        self.points[node], self.cuts[node] = sample[best], cut
        self._split(2 * node + 1, sample[spread[best] <= cut])
        self._split(2 * node + 2, sample[spread[best] > cut])

    def overlaps(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of a point, shard) for all shards within ``radius`` of the point."""
        at = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            far = np.bitwise_count(points[at] ^ self.points[node]).astype(np.int64)
            left, right = far - radius <= self.cuts[node], far + radius > self.cuts[node]
            at = np.concatenate([at[left], at[right]])
            node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        return at, node - len(self.points)


class Groups:
    """Union-find over array positions."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            self.flatten()

    def flatten(self) -> None:
        while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
            self.parent = up


def link_close(points, queries, members, radius: int, groups: Groups, levels: int = 3) -> None:
    """Link each query with each member within ``radius``; both are positions in ``points``."""
    if len(queries) * len(members) <= 1 << 18 or not levels:
        step = max(1, (1 << 18) // max(1, len(members)))
        for s in range(0, len(queries), step):
            some = queries[s : s + step]
            near = np.bitwise_count(points[some][:, None] ^ points[members][None, :]) <= radius
            q, m = np.nonzero(near)
            groups.link(some[q], members[m])
        return
    vantage = points[members[len(members) // 2]]
    far_m = np.bitwise_count(points[members] ^ vantage).astype(np.int64)
    far_q = np.bitwise_count(points[queries] ^ vantage).astype(np.int64)
    order = np.argsort(far_m, kind="stable")
    members, far_m = members[order], far_m[order]
    for d in np.unique(far_q):
        low, high = np.searchsorted(far_m, [d - radius, d + radius + 1])
        if low < high:
            some = queries[far_q == d]
            link_close(points, some, members[low:high], radius, groups, levels - 1)


def _shard_links(points: DataFrame, total: int, radius: int) -> DataFrame:
    """(a, b) fingerprints whose links connect what is within ``radius``; a spanning star per cell.

    There are ``total`` points.
    """
    spark = points.sparkSession
    share = min(4, max(1, total))  # the sample is a quarter of the fingerprints at most
    sample = (
        points.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, total // share)).select("fp").collect()
    )
    # A ball overlaps most shards of a deep tree: with one shard for every 8 sqrt(n) points,
    # copies of points and comparisons in a shard both grow more slowly than pairs would.
    wanted = max(1, isqrt(total) // 8).bit_length() - 1
    depth = min(wanted, max(0, (len(sample) // 16).bit_length() - 1))
    tree = VantageTree(np.array([r.fp for r in sample], np.int64).view(np.uint64), depth)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(every), 4_096):
                fps = every[s : s + 4_096]
                home_of, home = shared.value.overlaps(fps, 0)
                homes = np.empty(len(fps), np.int64)
                homes[home_of] = home
                at, shard = shared.value.overlaps(fps, radius)
                keep = shard >= homes[at]  # of two shards, the later one has the pair
                at, shard = at[keep], shard[keep]
                yield pa.record_batch(
                    [pa.array(fps[at].view(np.int64)), pa.array(shard), pa.array(shard == homes[at])],
                    names=["fp", "shard", "home"],
                )

    placed = settle(points.select("fp").mapInArrow(place, "fp long, shard long, home boolean"))
    cuts = placed.groupBy("shard").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / MEMBERS).cast("int").alias("members"),
        F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("queries"),
    )
    # One row per shard, of which there are no more than the sample has fingerprints.
    cells = placed.join(F.broadcast(cuts), "shard").filter("members > 0")
    mine = F.pmod(F.xxhash64("fp"), "members").cast("int")
    asks = F.pmod(F.xxhash64("fp", F.lit(1)), "queries").cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    queries = cells.select("fp", "shard", F.lit(False).alias("member"), asks.alias("q"), F.explode(span("members")).alias("m"))
    members = cells.filter("home").select("fp", "shard", F.lit(True).alias("member"), F.explode(span("queries")).alias("q"), mine.alias("m"))

    def search(cell):
        fps = cell["fp"].to_numpy().view(np.uint64)
        member = cell["member"].to_numpy()
        nodes, at = np.unique(fps, return_inverse=True)
        groups = Groups(len(nodes))
        link_close(nodes, at[~member], at[member], radius, groups)
        groups.flatten()
        tied = np.flatnonzero(groups.parent != np.arange(len(nodes)))
        ends = nodes[tied], nodes[groups.parent[tied]]
        return pa.table({n: pa.array(x.view(np.int64)) for n, x in zip("ab", ends)})

    return (
        queries.unionAll(members).groupBy("shard", "q", "m").applyInArrow(search, "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id, fp, component) of every row; component is the smallest id that links reach."""
    rows = settle(fingerprints(docs, id_column, text))
    points = settle(rows.groupBy("fp").agg(F.min("id").alias("first")), rows=rows.count())
    total = points.count()
    links = _shard_links(points, total, radius)
    groups = connected_components(links, total).withColumnRenamed("node", "fp")
    joined = points.join(groups, "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = joined.groupBy("label").agg(F.min("first").alias("component"))
    # Written first: AQE can split a fingerprint with very many rows only if neither side
    # comes from an aggregation.
    both = settle(joined, rows=total).join(settle(smallest, rows=total), "label")
    of = settle(both.select("fp", "component"), rows=total)
    return rows.join(of, "fp").select("id", "fp", "component")


def hex_digits(fp: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of smallest id of each group, once; rows with a null id stay as they are.

    Of different rows with that id, the first by text and then by the other columns stays.
    """
    kept = (
        near_duplicates(docs, id_column, text)
        .filter(F.col("id") == F.col("component"))
        .select(F.col("id").alias(id_column))
        .distinct()
    )
    # An id is repeated rarely; the window's partial limit keeps one row of it per task.
    others = [c for c in docs.columns if c not in (id_column, text)]
    stay = first_event(docs.join(kept, id_column), id_column, text, others).select(*docs.columns)
    return stay.unionAll(docs.filter(F.col(id_column).isNull()))
