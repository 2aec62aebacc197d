import hashlib

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import substring_dedup as s
from .helpers import documents, rows, words


def brute(docs, size):
    """(id, n_words, n_removed, digest) by comparing all windows."""
    first = {}
    for i, text in docs:
        own = words(text)
        for k in range(len(own) - size + 1) if i is not None else ():
            gram = tuple(own[k : k + size])
            first[gram] = min(i, first.get(gram, i))
    out = []
    for i, text in docs:
        own = words(text)
        gone = set()
        for k in range(len(own) - size + 1) if i is not None else ():
            if first[tuple(own[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("vocabulary, chunk", [(2, 100_000), (4, 60), (300, 100_000)])
def test_random_texts_match_brute_force(spark, monkeypatch, vocabulary, chunk):
    monkeypatch.setattr(s, "CHUNK_WORDS", chunk)
    random = np.random.default_rng(vocabulary)
    passages = [" ".join(f"p{j}x{k}" for k in range(random.integers(5, 60))) for j in range(6)]
    docs = []
    for i in range(120):
        own = [f"w{k}" for k in random.integers(0, vocabulary, random.integers(0, 50))]
        for _ in range(random.integers(0, 3)):
            own.insert(random.integers(0, len(own) + 1), passages[random.integers(0, 6)])
        docs.append((i, " ".join(own)))
    docs += [(i + 200, docs[i][1]) for i in range(15)] + [(300 + i, docs[0][1]) for i in range(40)]
    found = s.remove_repeats(documents(spark, docs, 7))
    assert rows(found, "id", "n_words", "n_removed", "kept_sha256") == brute(docs, 13)


def test_odd_rows(spark):
    long = " ".join(str(i * 7919 % 30_011) for i in range(40_000))
    text = " ".join(f"é{i}" for i in range(20))
    docs = [(4, text), (4, text), (3, None), (2, ""), (None, text), (None, None), (9, f"a\t{text}\nb"), (5, long), (8, "x " + long), (7, "short text")]
    found = s.remove_repeats(documents(spark, docs))
    assert rows(found, "id", "n_words", "n_removed", "kept_sha256") == brute(docs, 13)
    assert {r.kept_text for r in found.filter("id = 9").collect()} == {"a b"}
    assert s.remove_repeats(documents(spark, [])).count() == 0


def test_texts_with_the_same_id_keep_their_own_places(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(1, text), (2, "x y " + text), (2, "z")]
    found = s.remove_repeats(documents(spark, docs))
    assert rows(found, "id", "n_words", "n_removed", "kept_sha256") == brute(docs, 13)
    with pytest.raises(ValueError):
        s.remove_repeats(documents(spark, docs), threshold=5)


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_stream_gives_the_same_in_batches_of_any_size(size):
    random = np.random.default_rng(size)
    table = np.unique(random.integers(0, 6, (400, 3)), axis=0)
    columns = [*table.T, np.zeros(len(table), np.int32), np.zeros(len(table), bool)]
    batches = [
        pa.record_batch([pa.array(c[k : k + size]) for c in columns], names=["route", "part", "id", "mark", "known"])
        for k in range(0, len(table), size)
    ]
    got = sorted(
        row for b in s._resolve(batches) for row in zip(*(b[c].to_pylist() for c in ("part", "id", "covered")))
    )
    expected = []
    for route in np.unique(table[:, 0]):
        own = table[table[:, 0] == route]
        several = len(np.unique(own[:, 1])) > 1
        for _, part, i in own.tolist():
            least = own[own[:, 1] == part][:, 2].min()
            if i > least or several:
                expected.append((part, i, bool(i > least)))
    assert got == sorted(expected)
