"""A global row number that does not pull all rows into one partition."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.index import ascending
from cohortloom.operators.materialize import settle

# monotonically_increasing_id() = partition number << 33 | position in partition
POSITION_BITS = 33


def global_row_number(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "the_counter",
    distinct: bool = False,
) -> DataFrame:
    """``df`` with a gapless counter from 1 in the order of ``order_by``.

    ``distinct`` removes duplicate rows first; numbering makes every row unique,
    so it could not be done afterwards. Give a total order for a repeatable result.

    The rows are range-partitioned and sorted, then written to the checkpoint
    folder, which fixes partition numbers and positions even if executors are
    lost. A row's number is its position plus the rows in earlier partitions.
    Only one count per partition reaches the driver.
    """
    if distinct:
        df = df.distinct()
    order = ascending(order_by)
    ordered = settle(df.repartitionByRange(*order).sortWithinPartitions(*order))

    row_id, part, start = _unused([*df.columns, name], ("row_id", "part", "start"))
    placed = ordered.withColumn(row_id, F.monotonically_increasing_id()).withColumn(
        part, F.shiftright(row_id, POSITION_BITS)
    )
    counts = sorted(tuple(row) for row in placed.groupBy(part).count().collect())
    starts = accumulate((n for _, n in counts), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(number, first) for (number, _), first in zip(counts, starts)],
        f"{part} long, {start} long",
    )
    position = F.col(row_id).bitwiseAND((1 << POSITION_BITS) - 1)
    # One row per partition, so this side is always small.
    return (
        placed.join(F.broadcast(offsets), part)
        .withColumn(name, F.col(start) + position + 1)
        .select(*df.columns, name)
    )


def _unused(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """The names, each behind as many underscores as make it differ from every column."""
    longest = max((len(c) - len(c.lstrip("_")) for c in columns), default=0)
    return ["_" * (longest + 1) + name for name in names]
