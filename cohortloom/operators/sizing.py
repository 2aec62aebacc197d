"""Broadcast a side only when its measured size allows it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.materialize import settle

# Largest side that is broadcast, in estimated bytes. Beyond it the join is left
# to Catalyst and AQE, which shuffle both sides and split skewed partitions.
BROADCAST_BYTES = 64 * 1024 * 1024

ROW_BYTES = 32  # per-row cost of a broadcast hash table, besides the values
FIXED_BYTES = 8  # any fixed-width value
MARGIN = 16  # how many times larger than on disk a side may be in memory
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DatetimeType, T.NullType)


def _totals(side: DataFrame, number: int) -> DataFrame | None:
    """One row: the side's number and estimated size. None for nested columns."""
    fixed = ROW_BYTES
    variable = F.lit(0).cast("long")
    for field in side.schema:
        fixed += FIXED_BYTES
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            variable += F.coalesce(F.octet_length(side[field.name]), F.lit(0))
        elif not isinstance(field.dataType, FIXED_WIDTH):
            return None
    size = F.count(F.lit(1)) * fixed + F.coalesce(F.sum(variable), F.lit(0))
    return side.agg(size.alias("size")).select(F.lit(number).alias("side"), "size")


def measured_bytes(*sides: DataFrame) -> list[int | None]:
    """Estimated broadcast size of each side; None if it has nested columns.

    All sides are measured in one job. Each is summed within its tasks, so only
    one number per side reaches the driver.
    """
    totals = [t for t in (_totals(s, n) for n, s in enumerate(sides)) if t is not None]
    if not totals:
        return [None] * len(sides)
    found = dict(tuple(row) for row in reduce(DataFrame.unionAll, totals).collect())
    return [found.get(n) for n in range(len(sides))]


def are_small(*sides: DataFrame, limit: int | None = None) -> list[bool]:
    """Which sides may be broadcast.

    A side whose size Catalyst already bounds is not measured. Its estimate holds
    for files as they are on disk, hence the margin.
    """
    bound = BROADCAST_BYTES if limit is None else limit
    known = [MARGIN * _estimate(side) <= bound for side in sides]
    sizes = iter(measured_bytes(*(s for s, small in zip(sides, known) if not small)))
    return [small or (size := next(sizes)) is not None and size <= bound for small in known]


def _estimate(side: DataFrame) -> int:
    """Catalyst's estimate: never less than a filter leaves, product for a join."""
    return int(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_small(*sides: DataFrame, limit: int | None = None) -> list[DataFrame]:
    """The sides, with a broadcast hint on those that are small enough."""
    return [
        F.broadcast(side) if small else side
        for side, small in zip(sides, are_small(*sides, limit=limit))
    ]


def keep_keys(fact: DataFrame, keys: DataFrame, small: bool) -> DataFrame:
    """Rows of ``fact`` whose values in the columns of ``keys`` occur there.

    Large keys are materialized first. AQE splits a hot key only when both sides
    of the join come straight from a shuffle, and keys made by a distinct would
    hand their own partitioning to the join instead. Before the fact is shuffled, a
    filter of the keys drops nearly all rows that the join would drop (:func:`key_filter`).
    """
    if small:
        return fact.join(F.broadcast(keys), keys.columns, "left_semi")
    keys = settle(keys)
    words = key_filter(keys)
    if words is not None:
        fact = may_have_key(fact, words, keys.columns)
    return fact.join(keys, keys.columns, "left_semi")


WORD_BYTES = 48  # of a broadcast filter word, with its share of the hash table
KEYS_PER_WORD = 4  # about 2 in 100 absent keys pass then
CROWDED = 16  # keys per word beyond which a filter lets most rows pass
PROBES = 4


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter as a table of 64-bit words (word, bits), at most ``size`` rows.

    All bits of a key lie in one word, so a test is one lookup and one mask.
    """

    words: DataFrame
    size: int

    def merged(self, other: KeyFilter) -> KeyFilter:
        """The filter of both key sets; both must have the same size."""
        if self.size != other.size:
            raise ValueError("only filters of one size can be merged")
        both = self.words.unionAll(other.words).groupBy("word")
        return KeyFilter(both.agg(F.bit_or("bits").alias("bits")), self.size)


def _word(columns: Sequence[str], size: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(size).cast("long"))


def _mask(columns: Sequence[str]) -> Column:
    # The first value, a constant, makes this hash another one than the word's.
    spread = F.xxhash64(F.lit("mask"), *columns)
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * n).bitwiseAND(63).cast("int"))
        for n in range(PROBES)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(keys: DataFrame, size: int | None = None) -> KeyFilter | None:
    """The filter of some materialized keys; None if one that may be broadcast would be no use.

    Its size is bounded by :data:`BROADCAST_BYTES`, whatever the number of keys. Words are
    combined within tasks before they are shuffled. Give a ``size`` for filters to be merged.
    """
    if size is None:
        count, most = keys.count(), BROADCAST_BYTES // WORD_BYTES
        if most < 1 or count > most * CROWDED:
            return None
        size = max(1, min(most, count // KEYS_PER_WORD))
    words = keys.groupBy(_word(keys.columns, size).alias("word"))
    return KeyFilter(words.agg(F.bit_or(_mask(keys.columns)).alias("bits")), size)


def may_have_key(fact: DataFrame, keys: KeyFilter, columns: Sequence[str]) -> DataFrame:
    """``fact`` without rows whose key is surely not among the filter's; some others stay."""
    words = F.broadcast(keys.words.withColumnsRenamed({"word": "filter_word", "bits": "filter_bits"}))
    mask = _mask(columns)
    met = (F.col("filter_word") == _word(columns, keys.size)) & (F.col("filter_bits").bitwiseAND(mask) == mask)
    return fact.join(words, met, "left_semi")


def look_up(fact: DataFrame, dim: DataFrame, on: str, small: bool) -> DataFrame:
    """Rows of ``fact`` with the columns of their ``dim`` row.

    When ``dim`` is small its keys filter the fact first. Catalyst pushes such a
    semi-join through the joins of a fact that is itself a view, down to the
    table that holds the key, as long as the view computes its columns below its
    joins. It does not do so for the inner join.
    """
    if not small:
        return fact.join(dim, on)
    kept = fact.join(F.broadcast(dim.select(on)), on, "left_semi")
    return kept.join(F.broadcast(dim), on)
