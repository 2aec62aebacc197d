"""Medication orders of a cohort, labelled with drug classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.rules import DrugClass
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import are_small, keep_keys

ORDER_TIMES = ("order_placed_datetime", "order_start_datetime", "order_end_datetime")


def cohort_members(current_patients: DataFrame, person_ids: DataFrame) -> DataFrame:
    """Distinct (person, patient key) pairs of the persons listed in ``person_ids``."""
    current = current_patients.select("ir_id", "patient_key")
    return current.join(person_ids.select("ir_id"), "ir_id", "left_semi").distinct()


def classify_medications(
    medications: DataFrame, classes: Sequence[DrugClass], case_sensitive: bool = False
) -> DataFrame:
    """One row per medication and matching class; unmatched medications drop out.

    Classes overlap on purpose, so a medication can have several labels. The
    patterns look only at dimension columns, so they run once per medication
    and not once per order.
    """
    brand, generic = F.col("medication_name"), F.col("generic_name")
    labels = [
        F.when(c.condition(brand, generic, case_sensitive), F.lit(c.label)) for c in classes
    ]
    # A filter after the explode, since array_compact would leave codegen.
    return (
        medications.where(F.col("medication_key") > 0)
        .select(
            F.explode(F.array(*labels)).alias("med_class"),
            "medication_key",
            "medication_name",
            "generic_name",
        )
        .where(F.col("med_class").isNotNull())
    )


def medication_exposure(
    medications: DataFrame,
    orders: DataFrame,
    order_profile: DataFrame,
    cohort: DataFrame,
    patients: DataFrame,
    classes: Sequence[DrugClass],
    statuses: Sequence[str],
    case_sensitive: bool = False,
) -> DataFrame:
    """Distinct (class, medication, order times, patient key, person) of the cohort.

    The order fact is read once for all classes. Cohort keys come from
    ``cohort``, the person id from ``patients``.

    Duplicates are removed while the rows hold keys and times only; names and
    classes join afterwards. A join of distinct sides that keeps all their
    columns is distinct itself, so one pass of duplicate removal is enough. It
    comes before a shuffled join on ``patient_key``, never after it: there it
    would reuse that partitioning and so keep AQE from splitting a hot patient.
    Classified medications and large cohort keys are materialized: the patterns
    then run once, and only a side that comes straight from a shuffle lets AQE
    split the other one.
    """
    classified = settle(classify_medications(medications, classes, case_sensitive).distinct())
    accepted = order_profile.where(F.col("order_status").isin(*statuses))
    accepted = accepted.select("medication_order_profile_key")
    members = patients.select("patient_key", "ir_id").join(
        cohort.select("patient_key"), "patient_key", "left_semi"
    )
    members = members.distinct()
    small_classified, small_accepted, small_members = are_small(classified, accepted, members)

    placed = orders.where(F.col("medication_key") > 0)
    if small_classified:
        placed = keep_keys(placed, classified.select("medication_key"), small=True)
        classified = F.broadcast(classified)
    placed = keep_keys(placed, accepted, small_accepted)
    placed = placed.select("medication_key", *ORDER_TIMES, "patient_key")
    if small_members:
        placed = placed.join(F.broadcast(members), "patient_key").distinct()
    else:
        placed = placed.distinct().join(settle(members), "patient_key")
    exposure = placed.join(classified, "medication_key")
    return exposure.select(
        "med_class",
        "medication_key",
        "medication_name",
        "generic_name",
        *ORDER_TIMES,
        "patient_key",
        "ir_id",
    )
