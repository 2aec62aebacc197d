"""Importance resampling against a plain version."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from cohortloom.llm import importance
from cohortloom.llm.queries import QUERIES

from .helpers import SMALL, documents, rows


def features(text, most):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(run.encode()) % 10_000 for run in runs]


def plain(docs, target, most=1, percent=10, least=20):
    found = [(i, *features(text, most)) for i, text in docs]
    s = Counter(b for _, _, some in found for b in some)
    t = Counter(b for text in target for b in features(text, most)[1])
    all_s, all_t = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    scored = []
    for i, n, some in found:
        weight = math.floor(sum(map(gain, some)) / len(some)) if some else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(some), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((-x[4], x[0] is not None, x[0] or 0, k) for k, x in enumerate(scored) if x[1] >= least)
    rank = {k: place for place, (*_, k) in enumerate(fit[: len(fit) * percent // 100], 1)}
    return [(x[0], *x[2:], rank.get(k)) for k, x in enumerate(scored)]


def test_query_matches_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect()
    expected = plain([tuple(r) for r in docs], [r.text for r in target])
    found = QUERIES["op12_importance_resampling"](spark, SMALL)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert rows(found) == sorted(expected, key=str)
    assert sum(r[4] is not None for r in expected) > 5


TEXTS = [
    (1, "Alpha beta GAMMA"),
    (2, None),
    (3, ""),
    (4, " .,;! \0 \n"),
    (5, "\0alpha\0beta\0"),
    (6, "ÀÉ straße 漢字 Ünder line x1y2"),
    (None, "alpha beta beta"),
    (7, "alpha"),
    (8, "word " * 70 + "Alpha beta"),
    (8, "word " * 70 + "Alpha beta"),
    (9, "word " * 70 + "Alpha beta"),
]


@pytest.mark.parametrize("most, taken", [(1, 200_000), (3, 200_000), (3, 1), (3, 2), (2, 7)])
def test_runs_never_cross_documents(spark, monkeypatch, most, taken):
    found = importance.Features(10_000, most)
    monkeypatch.setattr(importance, "TAKEN_WORDS", taken)
    counted = Counter()
    n_words = Counter()
    for own, of, bucket in found([t.encode() if t else None for _, t in TEXTS]):
        n_words.update(own.tolist())
        counted.update(zip(of.tolist(), bucket.tolist()))
    expected = [features(t, most) for _, t in TEXTS]
    assert counted == Counter((k, b) for k, (_, some) in enumerate(expected) for b in some)
    assert n_words == Counter({k: n for k, (n, _) in enumerate(expected) if n})


@pytest.mark.parametrize("most", [1, 2])
def test_defined_cases(spark, most):
    docs = documents(spark, [(i, t, "s") for i, t in TEXTS])
    target = spark.createDataFrame([("alpha beta",), (None,), ("gamma",)], "text string")
    found = importance.resample(docs, target, max_words=most, percent=50, min_words=3)
    expected = plain(TEXTS, ["alpha beta", None, "gamma"], most, 50, 3)
    assert rows(found, "id", "n_features", "weight", "score", "rank") == sorted(expected, key=str)


def test_empty_tables(spark):
    none = documents(spark, [])
    target = spark.createDataFrame([], "text string")
    assert rows(importance.resample(none, target)) == []
    one = documents(spark, [(1, "a b c", "s")])
    assert rows(importance.resample(one, target, min_words=1, percent=100), "id", "rank") == [(1, 1)]


def test_one_very_long_text(spark):
    texts = [(1, "alpha beta " * 300_000), (2, "beta gamma " * 15)]
    target = spark.createDataFrame([("alpha",)], "text string")
    found = importance.resample(documents(spark, texts), target, percent=100)
    assert rows(found, "id", "n_features", "weight", "score", "rank") == sorted(plain(texts, ["alpha"], percent=100), key=str)
