"""First events that are kept up to date as facts arrive, without reading old facts again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortloom.operators.index import first_event
from cohortloom.sources.versions import committed_version, read_version, write_version


def merge_first_events(
    state: DataFrame | None,
    events: DataFrame,
    person: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_break: str | Sequence[str],
) -> DataFrame:
    """The first event of each person of a state and of new events; the result is a state again.

    A first event of first events is the first of all, so a state can be merged with any
    split of the facts, in any order, and with facts that it already has. New events keep one
    row per person in each task before they are shuffled; the state has one row per person.
    """
    first = first_event(events, person, order_by, tie_break)
    if state is None:
        return first
    return first_event(state.unionByName(first), person, order_by, tie_break)


def update_first_events(
    spark: SparkSession,
    folder: str,
    events: DataFrame,
    person: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_break: str | Sequence[str],
) -> DataFrame:
    """Merge new events into the state kept in ``folder``, commit it and read it.

    A run that is killed leaves the old state; the same events may then be merged again.
    """
    known = committed_version(spark, folder)
    state = None if known is None else read_version(spark, folder, known)
    return read_version(spark, folder, write_version(merge_first_events(state, events, person, order_by, tie_break), folder))
