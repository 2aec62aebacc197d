"""Target-distribution importance resampling: documents are drawn that look like a target text set.

Features are runs of 1 to ``max_words`` consecutive words, hashed into buckets. A bucket's gain
is the log ratio of its smoothed shares in the target and in the documents; a document weighs
the floored mean gain of its features. Gumbel noise, seeded by the document id, turns the
largest scores into a draw without replacement.

Batch concatenation: the texts of a batch are joined with a sentinel that no word holds. One
regular expression pass over the joined bytes finds all words, a binary search in the documents'
offsets tells whose each is, and a run of words whose ends belong to two documents is masked
before ``bincount`` adds up. Words are taken from the pass a bounded number at a time (the last
ones are carried on), so a very long text needs no more memory than many short ones, apart from
its own bytes.

Both passes over the documents are maps. Counts are summed within each task before they are
shuffled; one number per bucket reaches the driver and goes back with the scoring function
(``buckets`` is a parameter, so its size does not follow the data). Ranks come from one range
sort of narrow rows.

Defined cases: null and empty texts, and texts without words, have no features and weigh 0; a
null id is hashed as an empty one; equal scores rank by smaller id (null first), then by fewer
features; repeated rows are drawn as often as they are there; with no documents or no target
texts every share is the smoothed one. Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import modest_batches
from cohortloom.operators.materialize import settle
from cohortloom.operators.numbering import global_row_number

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of lower-cased UTF-8
SENTINEL = b"\0"
TAKEN_WORDS = 200_000  # words taken from the pass at a time
CACHED_WORDS = 300_000


class _Sums(dict):
    """CRC-32 of words, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = crc32(word)
        return found


class Features:
    """The features of a batch of texts, a bounded number of words at a time."""

    def __init__(self, buckets: int, max_words: int):
        self.buckets, self.max_words, self.sums = buckets, max_words, _Sums()

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document of each new word, document of each feature, bucket of each feature)."""
        bodies = [text or b"" for text in texts]
        begins = np.zeros(len(bodies), np.int64)
        np.cumsum([len(body) + len(SENTINEL) for body in bodies[:-1]], out=begins[1:])
        # Only ASCII letters change in bytes.lower().
        found = WORDS.finditer(SENTINEL.join(bodies).lower())
        carried_words: list[bytes] = []
        carried_docs = np.empty(0, np.int64)
        while some := [(match.start(), match.group()) for match in islice(found, TAKEN_WORDS)]:
            starts = np.fromiter((start for start, _ in some), np.int64, len(some))
            own = np.searchsorted(begins, starts, "right") - 1
            words = carried_words + [word for _, word in some]
            docs = np.concatenate([carried_docs, own])
            yield own, *self._runs(words, docs, len(carried_words))
            keep = min(self.max_words - 1, len(words))
            carried_words = words[len(words) - keep :]
            carried_docs = docs[len(docs) - keep :]

    def _runs(self, words: list[bytes], docs: np.ndarray, carried: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs that end in a word after the carried ones, without those across documents."""
        sums = list(map(self.sums.__getitem__, words))
        of, bucket = [], []
        for n in range(1, self.max_words + 1):
            if n > 1:
                sums = [crc32(b" " + word, before) for before, word in zip(sums, words[n - 1 :])]
            first = max(0, carried - n + 1)
            values = np.asarray(sums[first:], np.int64)
            end = docs[first + n - 1 :]
            whole = docs[first : len(docs) - n + 1] == end
            of.append(end[whole])
            bucket.append(values[whole] % self.buckets)
        return np.concatenate(of), np.concatenate(bucket)


def bucket_counts(
    texts: DataFrame, text: str = "text", buckets: int = BUCKETS, max_words: int = MAX_WORDS
) -> np.ndarray:
    """How many features of all texts are in each bucket."""
    modest_batches(texts.sparkSession)

    def count(batches):
        features, total = Features(buckets, max_words), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, bucket in features(batch.column(0).to_pylist()):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    bodies = texts.select(F.col(text).cast("binary").alias("body"))
    sums = bodies.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():  # one row per bucket at most
        counts[bucket] = n
    return counts


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares, floored."""
    buckets = len(target)
    all_target, all_source = int(target.sum()), int(source.sum())
    ratios = (
        float(t + 1) * (all_source + buckets) / (float(s + 1) * (all_target + buckets))
        for t, s in zip(target.tolist(), source.tolist())
    )
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weigh(
    docs: DataFrame,
    gain: np.ndarray,
    id_column: str = "doc_id",
    text: str = "text",
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    modest_batches(docs.sparkSession)

    def score(batches):
        features = Features(len(gain), max_words)
        for batch in batches:
            size = batch.num_rows
            words, counts, sums = (np.zeros(size, np.int64) for _ in range(3))
            for own, of, bucket in features(batch.column(1).to_pylist()):
                words += np.bincount(own, minlength=size)
                counts += np.bincount(of, minlength=size)
                # Sums of whole numbers far below 2**53 are exact in doubles.
                sums += np.bincount(of, weights=gain[bucket], minlength=size).astype(np.int64)
            mean = np.where(counts > 0, sums // np.maximum(counts, 1), 0)
            yield pa.record_batch(
                [batch.column(0), *map(pa.array, (words, counts, mean))],
                names=["id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(score, "id long, n_words long, n_features long, weight long")


def draw(
    weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """``weighed`` with score and rank; rank is null for rows that are not drawn.

    Of the rows with ``min_words`` words or more, ``percent`` of a hundred are drawn.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = settle(weighed.withColumn("score", F.col("weight") + noise))
    fits = F.col("n_words") >= min_words
    chosen = scored.filter(fits).count() * percent // 100
    ordered = scored.select(
        "*", F.when(fits, 0).otherwise(1).alias("late"), (-F.col("score")).alias("falling")
    )
    placed = global_row_number(ordered, ["late", "falling", "id", "n_features", "weight"], "place")
    rank = F.when(F.col("place") <= chosen, F.col("place"))
    return placed.select("id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document."""
    gain = gains(
        bucket_counts(target, target_text, buckets, max_words),
        bucket_counts(docs, text, buckets, max_words),
    )
    return draw(weigh(docs, gain, id_column, text, max_words), percent, min_words, seed)
