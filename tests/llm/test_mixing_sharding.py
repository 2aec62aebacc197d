from collections import defaultdict

from pyspark.sql import functions as F

from cohortloom.llm import mixing, sharding
from .helpers import SMALL, documents, rows, words


def water_fill(sizes):
    """Targets by the letter: share by weight, cap at three times the size, share again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else weight[s] * left / open_weight for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_and_cuts(spark):
    docs = [(i, "w " * (i % 9), ["b", "a", "é", "Z", None][min(i % 11, 4)]) for i in range(200)]
    docs += [(900 + i, "w", f"tiny{i}") for i in range(3)] + [(950, "w w", "a")] * 4 + [(None, "q q", "b"), (960, None, "empty")]
    frame = documents(spark, docs)
    mixed = mixing.mix(frame)
    assert mixed.columns.count("size") == 1
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(words(text))
    targets = water_fill(sizes)
    for r in mixed.collect():
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-9
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert taken == {s: int(t + 1e-9) for s, t in targets.items()}
    assert rows(mixed, "doc_id", "taken") == rows(mixing.mix(frame.repartition(5)), "doc_id", "taken")
    copied = mixing.copies(mixed, frame.columns)
    assert copied.columns == frame.columns
    again = copied.groupBy("source").agg(F.sum(F.size(F.split(F.btrim("text"), r"\s+"))).alias("n"))
    assert {r.source: r.n for r in again.collect()} == {s: n for s, n in taken.items() if n}


def test_a_cut_keeps_white_space(spark):
    frame = spark.createDataFrame([(1, " a\n\tb  c d", 4, 2), (2, "x y", 2, 5)], "doc_id long, text string, size int, taken int")
    assert rows(mixing.copies(frame, ["doc_id", "text"])) == [(1, " a\n\tb"), (2, "x y"), (2, "x y"), (2, "x")] or rows(
        mixing.copies(frame, ["doc_id", "text"])
    ) == sorted([(1, " a\n\tb"), (2, "x y"), (2, "x y"), (2, "x")], key=str)


def test_nothing_to_mix(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert rows(mixing.mix(documents(spark, [(1, None, "a"), (2, " ", "b")])), "taken", "target") == [(0, 0.0), (0, 0.0)]


def test_shards_fit_and_only_oversized_buckets_are_split(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    limit = 30_000
    found = sharding.shard(docs, limit=limit).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    size = defaultdict(int)
    for r in found:
        size[r.shard] += r.n_bytes
    shards = {r.shard: r.depth for r in found}
    for r in found:
        assert size[r.shard] == r.shard_bytes <= limit and len(r.shard) == r.depth
    for shard in shards:
        assert not any(other != shard and other.startswith(shard) for other in shards)
        parent = sum(n for other, n in size.items() if other.startswith(shard[:-1]))
        assert parent > limit


def test_one_key_with_very_many_rows(spark):
    docs = [(7, "x" * 90, "s")] * 400 + [(i, "y" * 50, "s") for i in range(300)] + [(8, "z" * 5_000, "s"), (9, None, "s"), (None, "n", "s")]
    found = sharding.shard(documents(spark, docs), limit=1_000).collect()
    assert len(found) == len(docs)
    size = defaultdict(int)
    for r in found:
        size[r.shard] += r.n_bytes
    assert all(size[r.shard] == r.shard_bytes for r in found)
    assert {r.doc_id for r in found if r.shard_bytes > 1_000} == {8}
    assert len({r.shard for r in found if r.doc_id == 7}) == 37  # 11 rows of 90 bytes a shard
    assert sharding.shard(documents(spark, [])).count() == 0


def test_written_shards_are_read_again(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    placed = sharding.shard(docs, limit=60_000)
    sharding.write_shards(placed, str(tmp_path / "s"))
    again = spark.read.schema("doc_id long, text string").parquet(str(tmp_path / "s"))
    assert rows(again, "doc_id", "text") == rows(docs)


HELPERS = ("_hash", "_bytes", "_cell", "_run", "_row", "_source", "_in", "_start", "_before", "_key", "_of", "hash", "cell", "run", "bytes",
           "of", "within_cell", "start", "before", "key", "number", "first", "most", "contents", "level", "parent", "above", "target_of")


def with_helper_names(frame):
    return frame.withColumns({name: F.lit(name) for name in HELPERS})


def test_helper_names_as_extra_columns(spark):
    data = [(i % 40, "w " * (i % 9), f"s{i % 3}") for i in range(120)] + [(7, "hot " * 40, "s1")] * 30
    frame = documents(spark, data)
    plain = mixing.mix(frame), sharding.shard(frame, limit=900)
    named = mixing.mix(with_helper_names(frame)), sharding.shard(with_helper_names(frame), limit=900)
    for expected, found in zip(plain, named):
        assert rows(found, *expected.columns) == rows(expected)
        assert {tuple(r[n] for n in HELPERS) for r in found.collect()} == {HELPERS}
    assert any("-" in r.shard for r in plain[1].collect())


def test_runs_of_one_key_do_not_depend_on_partitions(spark):
    data = [(1, f"text {i % 50} " * 3, f"s{i}") for i in range(300)]
    found = [rows(sharding.shard(documents(spark, data, n), limit=500), "source", "shard", "shard_bytes") for n in (1, 7)]
    assert found[0] == found[1] and len({r[1] for r in found[0]}) > 5


def test_very_long_texts(spark):
    data = [(1, "long words " * 200_000, "a"), (2, "short", "a"), (3, None, "b"), (4, "x" * 3_000_000, "b")]
    sharded = {r.doc_id: r for r in sharding.shard(documents(spark, data)).collect()}
    assert sharded[1].n_bytes == sharded[1].shard_bytes == 2_200_000 and sharded[4].shard_bytes == 3_000_000
    mixed = {r.doc_id: r for r in mixing.mix(documents(spark, data)).collect()}
    assert mixed[1].size == 400_000 and mixed[4].size == 1 and mixed[4].taken == 3


def test_cells_are_read_twice_at_most(spark, monkeypatch):
    seen = []
    real = sharding._cells
    monkeypatch.setattr(sharding, "_cells", lambda rows, depth: seen.append(depth) or real(rows, depth))
    sharding.shard(documents(spark, [(i, "words", "s") for i in range(100)]))
    assert seen == [sharding.FIRST_BITS]
    sharding.shard(documents(spark, [(i, "w" * 500, "s") for i in range(400)]), limit=1)
    assert seen[1:3] == [sharding.FIRST_BITS, 21]
