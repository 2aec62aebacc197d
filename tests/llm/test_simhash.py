from pathlib import Path

import numpy as np
import pytest
import xxhash

from cohortloom.llm import simhash as s
from cohortloom.llm.components import connected_components
from cohortloom.operators.materialize import ensure_checkpoint_dir
from .helpers import SMALL, documents, rows, words


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = words(lower)
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def components(ids, fps, radius=4):
    parent = dict(zip(ids, ids))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                p, q = find(ids[i]), find(ids[j])
                parent[max(p, q)] = min(p, q)
    return [find(i) for i in ids]


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = docs.select("doc_id", "text").toPandas()
    fps = [fingerprint(t) for t in table.text]
    groups = components(table.doc_id.tolist(), fps)
    found = s.near_duplicates(docs).select("id", s.hex_digits(), "component")
    assert rows(found) == sorted(
        ((i, f"{f:016x}", g) for i, f, g in zip(table.doc_id.tolist(), fps, groups)), key=str
    )
    kept = s.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(groups))


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    texts = [(5, None), (3, ""), (9, " \n"), (None, "a b c d e"), (4, "A b c"), (6, "a B c"), (6, "a B c"), (None, None), (8, long)]
    found = s.near_duplicates(documents(spark, texts))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.component, []).append(r.id)
    assert sorted(groups[3], key=str) == [3, 5, 9, None]
    assert groups[4] == [4, 6, 6] or sorted(groups[4]) == [4, 6, 6]
    assert groups[None] == [None] and groups[8] == [8]
    kept = s.one_of_each(documents(spark, texts))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 4, 8, None, None]
    assert s.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("depth", [0, 3, 6])
def test_no_shard_that_a_ball_overlaps_is_missed(depth):
    random = np.random.default_rng(depth)
    points = random.integers(0, 2**63, 600, dtype=np.uint64)
    points[300:] = points[:300] ^ np.uint64(0b1011)
    tree = s.VantageTree(points[:100], depth)
    home = dict(zip(*(x.tolist() for x in tree.overlaps(points, 0))))
    assert len(home) == len(points)
    near = set(zip(*(x.tolist() for x in tree.overlaps(points, 4))))
    for i in range(300):
        assert (i, home[i + 300]) in near and (i + 300, home[i]) in near


def test_vantage_search_links_what_brute_force_links():
    random = np.random.default_rng(1)
    centre = random.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << random.integers(0, 64, (40, 60), dtype=np.uint64)
    points = np.unique((centre[:, None] ^ flips).ravel())
    every = np.arange(len(points))
    groups = s.Groups(len(points))
    s.link_close(points, every, every, 4, groups)
    groups.flatten()
    expected = components(every.tolist(), [int(p) for p in points])
    assert groups.parent.tolist() == expected


def test_long_chains_are_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 7), (1, 5), (5, 1)], "a long, b long")
    labels = dict(rows(connected_components(chain), "node", "label"))
    assert labels == {**{i: 100 for i in range(100, 161)}, 7: 7, 1: 1, 5: 1}


def test_a_shard_in_several_cells_finds_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = rows(s.near_duplicates(docs))
    monkeypatch.setattr(s, "MEMBERS", 20)
    monkeypatch.setattr(s, "QUERIES", 30)
    assert rows(s.near_duplicates(docs)) == expected


def test_few_rows_make_few_files(spark):
    """The number of files follows the rows, not the shuffle's partitions: each costs processes and their memory."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    docs = documents(spark, [(i, f"some text of number {i % 20} here and there") for i in range(60)])
    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "a long, b long").repartition(5)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        labels = connected_components(links)
        assert labels.rdd.getNumPartitions() == 1
        assert rows(labels) == sorted([*((i, 0) for i in range(10)), (20, 20), (21, 20)], key=str)
        written = set(folder.rglob("part-*"))
        found = s.near_duplicates(docs)
        files = len(set(folder.rglob("part-*")) - written)
        groups = found.select("id", "component").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert files < 64  # a single table of 64 files would be more
    assert len(groups) == 60 and all(r.component <= r.id % 20 for r in groups)
