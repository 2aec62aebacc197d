"""Outcome events of indexed persons, and their labels on the index rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.expressions import in_window
from cohortloom.operators.index import ascending
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import are_small, keep_keys
from cohortloom.operators.value_sets import load_keys


def events_for(
    index: DataFrame,
    diagnoses: DataFrame,
    value_keys: DataFrame,
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    settled: bool = False,
    small_index: bool | None = None,
) -> DataFrame:
    """Distinct (person, start time) of the value set's dated events.

    Events are those of the patient key on the person's index row; events under
    the person's other keys do not count. The fact is filtered by value set and
    load type before anything is shuffled. Set ``settled`` when ``index`` is
    materialized: it is then measured, unless ``small_index`` says what that
    would find, and broadcast when it fits.
    """
    persons = index.select("ir_id", "patient_key")
    value_keys = value_keys.select("diagnosis_key")
    loads = [] if profile is None else [load_keys(profile, load_types)]
    lookups = [value_keys, *loads]
    measure = settled and small_index is None
    small_lookups = are_small(*lookups, *([persons] if measure else []))
    if small_lookups.pop() if measure else small_index:
        persons = F.broadcast(persons)

    hits = diagnoses.where(F.col("start_datetime").isNotNull())
    for keys, small in zip(lookups, small_lookups):
        hits = keep_keys(hits, keys, small)
    hits = hits.select("patient_key", "start_datetime")
    return hits.join(persons, "patient_key").select("ir_id", "start_datetime").distinct()


def label_outcomes(
    index: DataFrame,
    events: DataFrame,
    columns: Sequence[str] = (
        "surgical_case_key",
        "ir_id",
        "patient_key",
        "visit_key",
        "surgery_start_datetime",
        "AF_dxDate",
        "discharge_datetime",
    ),
    label: str = "AF_dxDate",
    ordered: bool = True,
    settled: bool = False,
    small_index: bool | None = None,
) -> DataFrame:
    """Index rows with every event time of the person; NULL for a person with none.

    This is a left join, but one whose right side may hold a hot person, and
    AQE cannot split the right side of a left join. So the matches are an inner
    join, which it can split, and the persons without events are added to it.
    Those are found through one row per person, its number of events. Counting
    them, rather than asking whether there are any, makes both parts need the
    same distinct events, which are then computed once and their exchange reused.

    ``index`` is read by both parts and is materialized unless ``settled`` says
    that it is. The sort ends in the event time, so that a person with very many events is
    spread over several range partitions.
    """
    renamed = events.withColumnRenamed("start_datetime", label)
    if not settled:
        index = settle(index)
    if small_index is None:
        (small_index,) = are_small(index)
    side = F.broadcast(index) if small_index else index
    matched = renamed.join(side, "ir_id").select(*columns)
    counts = events.groupBy("ir_id").agg(F.count(F.lit(1)).alias("_n"))
    unmatched = (
        index.join(counts, "ir_id", "left")
        .where(F.col("_n").isNull())
        .withColumn(label, F.lit(None).cast(renamed.schema[label].dataType))
        .select(*columns)
    )
    labelled = matched.unionByName(unmatched)
    if not ordered:
        return labelled
    return labelled.orderBy(
        *ascending(["ir_id", "surgery_start_datetime", label, "surgical_case_key"])
    )


def within_window(
    labelled: DataFrame,
    start: str = "surgery_start_datetime",
    end: str = "discharge_datetime",
    event: str = "AF_dxDate",
) -> DataFrame:
    """Labels whose event lies in [start, end); persons without one drop out."""
    return labelled.where(in_window(F.col(event), F.col(start), F.col(end)))
