import numpy as np
import pytest

from cohortloom.llm import ann
from .helpers import SMALL, rows


def brute(ids, matrix, query, k):
    scores = [(-float(np.dot(matrix[query], v)), i) for i, v in zip(ids, matrix) if i != ids[query]]
    return [i for _, i in sorted(scores)[:k]]


def test_recall_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    data = table.toPandas()
    ids, matrix = data.vec_id.tolist(), np.array(data.embedding.tolist(), float)
    found = {}
    for r in ann.nearest(table).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    queries = [n for n, i in enumerate(ids) if i % 20 == 0]
    assert sorted(found) == sorted(ids[n] for n in queries)
    for n in queries:
        own = found[ids[n]]
        assert sorted(own) == list(range(1, 21))
        ordered = [own[rank] for rank in range(1, 21)]
        assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0]))
        for i, score in ordered:
            assert i != ids[n] and abs(score - matrix[n] @ matrix[ids.index(i)]) < 1e-12
        hits += len({i for i, _ in ordered} & set(brute(ids, matrix, n, 20)))
    assert hits >= 0.9 * 20 * len(queries)


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (20, [1.0, 0.0]), (7, None), (8, []), (9, [0.0, -0.0])]
    data += [(10, [None, 1.0]), (11, [nan, 1.0]), (12, [inf, 1.0]), (13, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (40, [0.0, 0.0]), (4, [-3.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<double>, score string").repartition(4)
    found = {}
    for r in ann.nearest(frame, k=3).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(x) for q, x in found.items()} == {
        0: [(1, 2, 2.0), (2, 1, 1.0), (3, 20, 1.0)],
        20: [(1, 2, 2.0), (2, 0, 1.0), (3, 1, 1.0)],
    }


def test_many_equal_vectors_and_small_cells(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 16)
    monkeypatch.setattr(ann, "CELL_QUERIES", 4)
    random = np.random.default_rng(0)
    matrix = random.normal(size=(300, 6))
    matrix[100:250] = matrix[100]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(frame, search_share=9.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 300, 20):
        assert [i for _, i in sorted(found[q])] == brute(list(range(300)), matrix, q, 20)


@pytest.mark.parametrize("times", [2, 25])
def test_repeated_rows_count_once(spark, times):
    random = np.random.default_rng(2)
    matrix = random.normal(size=(200, 6))
    matrix[40:80] = matrix[40]
    data = [(i, v.tolist()) for i, v in enumerate(matrix)]
    schema = "vec_id long, embedding array<double>"
    found = {}
    for r in ann.nearest(spark.createDataFrame(data * times, schema), search_share=9.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 200, 20):
        assert [i for _, i in sorted(found[q])] == brute(list(range(200)), matrix, q, 20)


def test_nothing_to_search(spark):
    schema = "vec_id long, embedding array<float>"
    assert rows(ann.nearest(spark.createDataFrame([], schema))) == []
    assert rows(ann.nearest(spark.createDataFrame([(1, [1.0])], schema))) == []
    assert rows(ann.nearest(spark.createDataFrame([(0, [1.0])], schema))) == []
