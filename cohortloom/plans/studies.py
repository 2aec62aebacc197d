"""The three feature extractions, each from warehouse views to its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortloom.functions import drugs, vocabulary
from cohortloom.functions.rules import DrugClass, Rule
from cohortloom.operators.history import covariate_matrix
from cohortloom.operators.index import first_event, index_events
from cohortloom.operators.materialize import settle
from cohortloom.operators.medications import cohort_members, medication_exposure
from cohortloom.operators.outcomes import events_for, label_outcomes, within_window
from cohortloom.operators.sizing import are_small
from cohortloom.operators.value_sets import value_set
from cohortloom.sources.warehouse import Warehouse

TIE_BREAK = ("surgical_case_key", "patient_key")


def surgery_outcomes(
    warehouse: Warehouse,
    outcome: Rule = vocabulary.AF_OUTCOME,
    codes: Sequence[str] = vocabulary.BYPASS_CODES,
    code_types: Sequence[str] = vocabulary.PROCEDURE_CODE_TYPES,
    load_types: Sequence[str] = vocabulary.ACCEPTED_LOAD_TYPES,
    during_stay: bool = False,
) -> DataFrame:
    """First inpatient surgery of each person with every outcome date, at any time.

    ``during_stay`` keeps only outcomes from the surgery until discharge. The
    first surgeries are written to the checkpoint folder once and read from
    there, as both the event lookup and the labelling use them.
    """
    surgeries = index_events(
        warehouse.view("coded_procedure"),
        warehouse.view("procedure"),
        warehouse.view("patient"),
        code_types,
        codes,
        encounters=warehouse.view("encounter_inpatient"),
    )
    index = first_event(surgeries, "ir_id", "surgery_start_datetime", TIE_BREAK)
    index = settle(
        index.select(
            "surgical_case_key",
            "ir_id",
            "patient_key",
            "visit_key",
            "surgery_start_datetime",
            "discharge_datetime",
        )
    )
    (small_index,) = are_small(index)
    events = events_for(
        index,
        warehouse.view("diagnosis_event"),
        value_set(warehouse.view("diagnosis_terminology"), outcome),
        warehouse.view("diagnosis_event_profile"),
        load_types,
        settled=True,
        small_index=small_index,
    )
    labelled = label_outcomes(index, events, settled=True, small_index=small_index)
    return within_window(labelled) if during_stay else labelled


def surgery_history(
    warehouse: Warehouse,
    conditions: Sequence[Rule] = vocabulary.HISTORY_CONDITIONS,
    codes: Sequence[str] = vocabulary.BYPASS_CODES,
    code_types: Sequence[str] = vocabulary.PROCEDURE_CODE_TYPES,
    load_types: Sequence[str] = vocabulary.ACCEPTED_LOAD_TYPES,
    index_order: str = "procedure_name",
    case_sensitive: bool = False,
) -> DataFrame:
    """One row per surgical person: age, race, gender and conditions before surgery.

    The index surgery is the first by *procedure name*, not by date, and needs
    no inpatient encounter. It can therefore differ from the index surgery of
    :func:`surgery_outcomes`; pass ``index_order="surgery_start_datetime"`` for
    the earliest one.
    """
    surgeries = index_events(
        warehouse.view("coded_procedure"),
        warehouse.view("procedure"),
        warehouse.view("patient"),
        code_types,
        codes,
    )
    tie_break = ("surgery_start_datetime", *TIE_BREAK)
    index = settle(
        first_event(surgeries, "ir_id", index_order, tie_break).select(
            "ir_id",
            "patient_key",
            "birth_date",
            "race_1",
            "gender",
            "surgery_start_datetime",
            "surgery_start_date_key",
        )
    )
    return covariate_matrix(
        index,
        warehouse.view("diagnosis_event"),
        warehouse.view("diagnosis_terminology"),
        conditions,
        warehouse.view("diagnosis_event_profile"),
        load_types,
        case_sensitive,
        settled=True,
    )


def drug_exposure(
    warehouse: Warehouse,
    person_ids: DataFrame,
    classes: Sequence[DrugClass] = drugs.DRUG_CLASSES,
    statuses: Sequence[str] = drugs.ACCEPTED_ORDER_STATUSES,
    case_sensitive: bool = False,
) -> DataFrame:
    """Distinct classified medication orders of the persons in ``person_ids`` (``ir_id``)."""
    return medication_exposure(
        warehouse.view("medication"),
        warehouse.view("medication_order"),
        warehouse.view("medication_order_profile"),
        cohort_members(warehouse.view("patient_current"), person_ids),
        warehouse.view("patient"),
        classes,
        statuses,
        case_sensitive,
    )
