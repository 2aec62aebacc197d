"""Events inside windows of other events, for all of a person's windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.expressions import in_window
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import are_small

# Days in a time bucket, by level. A window is held by the first level that cuts it into
# PIECES buckets or so, and an event by one bucket of each level in use.
LEVELS = (32, 512, 8_192, 131_072)
PIECES = 16


def events_in_windows(
    windows: DataFrame,
    events: DataFrame,
    start: str,
    end: str,
    moment: str,
    on: str = "patient_key",
) -> DataFrame:
    """Every pair of a window and an event of the same ``on`` with the event in [start, end).

    The join has a time bucket as a second equal key. A person with very many windows and events
    is so split by time, and meets only what is near, where a join by person alone would hold all
    pairs of the person together before it tests the times. A window is copied to the
    buckets it touches, PIECES + 1 at most unless it is longer than a few thousand years; an
    event has one bucket a level, so every pair is found once.

    Windows without a start or end, or that end before they start, hold nothing; neither do
    rows without ``on``, and events without a time are in none. Rows that are there twice are paired
    twice. Columns other than ``on`` must have different names on both sides.
    """
    shared = {c.lower() for c in windows.columns} & {c.lower() for c in events.columns} - {on.lower()}
    if shared:
        raise ValueError(f"both sides have {sorted(shared)}")
    days = F.datediff(F.col(end), F.col(start))
    level = F.when(days <= LEVELS[0] * PIECES, 0)
    for number, size in enumerate(LEVELS[1:-1], start=1):
        level = level.when(days <= size * PIECES, number)
    sizes = F.array(*map(F.lit, LEVELS))
    held = windows.where((F.col(start) < F.col(end)) & F.col(on).isNotNull())
    held = settle(held.withColumn("_level", level.otherwise(len(LEVELS) - 1)))
    used = sorted(r[0] for r in held.select("_level").distinct().collect())  # one row a level at most
    touched = F.sequence(
        _bucket(F.col(start), F.get(sizes, F.col("_level"))), _bucket(F.col(end), F.get(sizes, F.col("_level")))
    )
    left = held.withColumn("_bucket", F.explode(touched))
    places = [
        F.struct(F.lit(n).alias("_level"), _bucket(F.col(moment), F.lit(LEVELS[n])).alias("_bucket")) for n in used
    ]
    right = events.where(F.col(moment).isNotNull() & F.col(on).isNotNull())
    if len(used) == 1:
        right = right.select("*", places[0].alias("_place"))
    else:
        right = right.withColumn("_place", F.explode(F.array(*places))) if used else right.withColumn(
            "_place", F.struct(F.lit(0).alias("_level"), F.lit(0).cast("long").alias("_bucket"))
        )
    right = right.select("*", "_place.*").drop("_place")
    # Copies of windows in their buckets are part of what is measured.
    (small,) = are_small(left)
    met = right.join(F.broadcast(left) if small else left, [on, "_level", "_bucket"])
    met = met.where(in_window(F.col(moment), F.col(start), F.col(end)))
    return met.select(on, *(c for c in windows.columns if c != on), *(c for c in events.columns if c != on))


def _bucket(moment: Column, size: Column) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / size)
