"""Index events: qualifying procedures, and the first one of each person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.expressions import date_key_to_timestamp, normalized_name
from cohortloom.operators.code_tables import of_code_table
from cohortloom.operators.sizing import are_small, look_up

NO_ENCOUNTER = -2  # sentinel key: the procedure belongs to no inpatient encounter


def index_events(
    procedures: DataFrame,
    procedure_dim: DataFrame,
    patients: DataFrame,
    code_types: Sequence[str] | None,
    codes: Sequence[str] | DataFrame,
    encounters: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """All qualifying dated procedures with the patient's demographics.

    Code system and code are tested independently. ``codes`` may be a table with the
    column ``procedure_code`` or, if system and code go together, also ``code_type``; without
    ``code_types`` any system counts. With ``encounters`` only
    procedures of a real inpatient encounter count, and its discharge time is
    added. ``carry`` names further patient columns to pass through, such as
    record numbers. A person may have many rows, and duplicate source rows stay.
    """
    qualifying = procedure_dim
    if code_types is not None:
        qualifying = qualifying.where(F.col("code_type").isin(*code_types))
    if isinstance(codes, DataFrame):
        qualifying = of_code_table(qualifying, codes)
    else:
        qualifying = qualifying.where(F.col("procedure_code").isin(*codes))
    qualifying = qualifying.select(
        "procedure_key", normalized_name(F.col("procedure_name")).alias("procedure_name")
    )
    performed = procedures.where(F.col("coded_procedure_date_key").isNotNull()).select(
        "coded_procedure_key",
        "patient_key",
        "procedure_key",
        "visit_key",
        "encounter_inpatient_key",
        "coded_procedure_date_key",
    )
    if encounters is not None:
        # The sentinel is a hot key: drop it before any shuffle on that key.
        performed = performed.where(F.col("encounter_inpatient_key") != NO_ENCOUNTER)
    (small,) = are_small(qualifying)
    events = look_up(performed, qualifying, "procedure_key", small)
    if encounters is not None:
        stays = encounters.select("encounter_inpatient_key", "discharge_datetime")
        events = events.join(stays, "encounter_inpatient_key")
    demographics = ["birth_date", "race_1", "gender", *carry, "death_date"]
    events = events.join(patients.select("ir_id", "patient_key", *demographics), "patient_key")

    day = F.col("coded_procedure_date_key")
    return events.select(
        F.col("coded_procedure_key").alias("surgical_case_key"),
        "ir_id",
        "patient_key",
        "visit_key",
        "encounter_inpatient_key",
        "procedure_name",
        date_key_to_timestamp(day).alias("surgery_start_datetime"),
        day.alias("surgery_start_date_key"),
        date_key_to_timestamp(day).alias("surgery_end_datetime"),
        day.alias("surgery_end_date_key"),
        *(["discharge_datetime"] if encounters is not None else []),
        *demographics,
    )


def ascending(columns: Sequence[str]) -> list[Column]:
    """Sort keys in ascending order, NULL first."""
    return [F.col(c).asc_nulls_first() for c in columns]


def _names(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_event(
    events: DataFrame,
    person: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_break: str | Sequence[str],
) -> DataFrame:
    """The first row of each person by ``order_by``, then ``tie_break``.

    ``tie_break`` should make the order total, so that a rerun gives the same
    row. Each task keeps one row per person before the shuffle (a partial window
    group limit), so a person with very many rows costs no more than any other.
    """
    order = ascending(_names(order_by) + _names(tie_break))
    window = Window.partitionBy(*_names(person)).orderBy(*order)
    return events.withColumn("rk", F.row_number().over(window)).where("rk = 1").drop("rk")
