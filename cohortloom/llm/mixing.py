"""Mixing sources to target weights, with native column expressions only.

Every row gets a random key, the hash of its id and a seed. Within each source the rows are
taken in key order until the source's budget is reached exactly: whole passes over the source
first (epochs), then a prefix, whose last document is cut. The order needs no global sort: equal ranges
of keys are cells, sizes are summed per cell, a prefix sum over a source's cells gives each
cell's start, and a running sum inside a cell gives each row's place. A source with a third
of all rows therefore is spread over its 65,536 cells like any other.

Targets are the sources' shares by weight, at most ``max_epochs`` times their size; the excess
goes to the others by weight until none is above. Each round of that is one aggregation over
sources, which returns two numbers.

Defined cases: a null source is one of its own, last in order; null texts have size 0 and are
taken 0 times; repeated rows are taken one by one; rows of equal key are ordered by id and
size; a text of any length has its number of words as size; an empty table gives an empty result. Input
columns named like the new ones are replaced; helper columns take names that no input column has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import fresh, word_count
from cohortloom.operators.materialize import settle
from cohortloom.operators.numbering import global_row_number

CYCLE = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
CELL_BITS = 16
NEW = ("size", "source_size", "target", "taken")


def random_key(id_column: Column, seed: str) -> Column:
    """60 bits of the MD5 of id and seed, the same on every engine."""
    text = F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, cycle: Sequence[int] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with weight and target, in words."""
    ordered = global_row_number(
        sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_number"
    ).drop("_last")
    turns = F.array(*map(F.lit, cycle))
    weighted = settle(
        ordered.withColumn("weight", F.get(turns, (F.col("_number") - 1) % len(cycle))).drop("_number")
    )
    limit = max_epochs * F.col("source_size")
    total, share, state = None, 0.0, None
    while True:
        # A source is above its limit at the present share of one unit of weight.
        above = F.lit(False) if state is None else F.col("weight") * share > limit
        row = weighted.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, limit).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        total = row.total or 0
        if state == (row.capped, row.weights):
            break
        state = row.capped, row.weights
        if not row.weights:
            break
        share = (total - row.capped) / row.weights
    target = F.least(F.col("weight") * F.lit(float(share)), limit.cast("double"))
    return weighted.withColumn("target", target)


def mix(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text",
    cycle: Sequence[int] = CYCLE, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
    size: Column | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target (its source's) and taken, all in words.

    ``taken`` is at most ``max_epochs`` times the size. Over a source it sums to the whole
    part of the target. ``size`` may give the sizes if they are known already.
    """
    others = [c for c in docs.columns if c.lower() not in NEW or c in (id_column, source)]
    taken_names = [*docs.columns, *NEW]
    key, cell, of, within_cell, start, before_row = (
        fresh(taken_names, name) for name in ("key", "cell", "of", "within_cell", "start", "before")
    )
    sizes = word_count(F.col(text)) if size is None else size
    measured = docs.withColumn("size", sizes)
    measured = measured.select(
        *(F.col(c) for c in others), "size", random_key(F.col(id_column), seed).alias(key)
    ).withColumn(cell, F.shiftright(key, 60 - CELL_BITS).cast("int"))

    cells = settle(
        measured.groupBy(F.col(source).alias("source"), F.col(cell).alias("cell"))
        .agg(F.sum("size").alias("cell_size"))
    )
    totals = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    targets = source_targets(totals, cycle, max_epochs).withColumnRenamed("source", "target_of")
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        cells.withColumn("cell_start", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
        .join(targets, F.col("source").eqNullSafe(F.col("target_of")))
        .select(
            F.col("source").alias(of), F.col("cell").alias(within_cell), F.col("cell_start").alias(start),
            "source_size", "target",
        )
    )
    within = (
        Window.partitionBy(source, cell).orderBy(key, id_column, "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = measured.join(
        starts, F.col(source).eqNullSafe(F.col(of)) & (F.col(cell) == F.col(within_cell))
    ).withColumn(before_row, F.col(start) + F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target")
    passes = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    rest = budget - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col(before_row)))
    return placed.select(
        *others, "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def copies(mixed: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """The rows of a mix: each document as often as it is taken, cut where it is taken in part.

    A cut keeps the first words with the white space between them.
    """
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    turns = F.sequence(F.lit(1), whole + F.when(part > 0, 1).otherwise(0))
    name = fresh(mixed.columns, "_turn")
    repeated = mixed.filter("taken > 0").withColumn(name, F.explode(turns))
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.when(F.col(name) <= whole, F.col(text)).otherwise(
        F.array_join(F.slice(pieces, 1, part), "")
    )
    return repeated.select(*(cut.alias(c) if c == text else F.col(c) for c in columns))
