"""Conditions recorded before the index date: one pass over the diagnosis fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.expressions import any_of, year_boundaries
from cohortloom.functions.rules import Rule
from cohortloom.operators.index import first_event
from cohortloom.operators.sizing import are_small, keep_keys, look_up
from cohortloom.operators.value_sets import load_keys


def of_patients(events: DataFrame, patients: DataFrame, small: bool) -> DataFrame:
    """Rows of ``events`` under the patient keys of ``patients``, which is materialized.

    Both sides of a shuffled join come straight from a shuffle then, so AQE can
    split a hot patient.
    """
    keys = patients.select("patient_key")
    return events.join(F.broadcast(keys) if small else keys, "patient_key", "left_semi")


def history_firsts(
    index: DataFrame,
    diagnoses: DataFrame,
    terminology: DataFrame,
    rules: Sequence[Rule],
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    case_sensitive: bool = False,
    settled: bool = False,
) -> DataFrame:
    """Each person's earliest event of each condition, with the condition's label.

    Guarded branches need an event strictly before the index date; events of
    unguarded branches count whenever they are, and an undated one comes first.

    The fact is read once for all rules. A patient's earliest event precedes the
    index date exactly if any does, so the facts shrink to at most two candidates
    per patient and rule (guarded and not) before they meet the index, however
    many events a patient has. Set ``settled`` when ``index`` is materialized: the
    fact is then limited to the indexed patients before anything is aggregated.
    """
    marks = [
        F.when(
            rule.condition(case_sensitive=case_sensitive),
            F.struct(
                F.lit(number).alias("rule"),
                (~rule.condition(guarded=False, case_sensitive=case_sensitive)).alias("guarded"),
            ),
        )
        for number, rule in enumerate(rules)
    ]
    terms = (
        terminology.select("diagnosis_key", "diagnosis_code", F.explode(F.array(*marks)).alias("m"))
        .where(F.col("m").isNotNull())
        .select("diagnosis_key", "diagnosis_code", "m.rule", "m.guarded")
    )
    loads = [] if profile is None else [load_keys(profile, load_types)]
    patients = [index.select("patient_key")] if settled else []
    small_terms, *others = are_small(terms, *patients, *loads)
    hits = diagnoses
    if settled:
        hits = of_patients(hits, patients[0], others.pop(0))
    for keys, small in zip(loads, others):
        hits = keep_keys(hits, keys, small)
    hits = look_up(hits, terms, "diagnosis_key", small_terms).where(
        ~F.col("guarded") | F.col("start_date_key").isNotNull()
    )
    hits = hits.select(
        "patient_key", "rule", "guarded", "start_date_key", "diagnosis_event_key", "diagnosis_code"
    )
    tie_break = ["diagnosis_event_key", "diagnosis_code"]
    candidates = first_event(hits, ["patient_key", "rule", "guarded"], "start_date_key", tie_break)
    before = F.col("surgery_start_date_key") > F.col("start_date_key")
    counted = (
        index.select("ir_id", "patient_key", "surgery_start_date_key")
        .join(candidates, "patient_key")
        .where(~F.col("guarded") | before)
    )
    labels = F.array(*(F.lit(rule.label) for rule in rules))
    return first_event(counted, ["ir_id", "rule"], "start_date_key", tie_break).select(
        "ir_id",
        "surgery_start_date_key",
        "start_date_key",
        "diagnosis_event_key",
        "diagnosis_code",
        F.get(labels, F.col("rule")).alias("condition"),
    )


def history_flag(
    index: DataFrame,
    diagnoses: DataFrame,
    terminology: DataFrame,
    rule: Rule,
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    case_sensitive: bool = False,
    settled: bool = False,
) -> DataFrame:
    """:func:`history_firsts` of one condition."""
    return history_firsts(
        index, diagnoses, terminology, [rule], profile, load_types, case_sensitive, settled
    )


def condition_terms(
    terminology: DataFrame, rules: Sequence[Rule], case_sensitive: bool = False
) -> DataFrame:
    """Terminology keys with one boolean per rule and kind of branch.

    ``g_<rule>`` marks keys whose events must precede the index date, ``f_<rule>``
    those that count at any date. Keys outside every rule are dropped.
    """
    marks = []
    for rule in rules:
        if rule.has_guarded:
            marks.append(rule.condition(True, case_sensitive).alias(f"g_{rule.name}"))
        if rule.has_unguarded:
            marks.append(rule.condition(False, case_sensitive).alias(f"f_{rule.name}"))
    marked = terminology.select("diagnosis_key", *marks)
    names = [c for c in marked.columns if c != "diagnosis_key"]
    return marked.where(any_of([F.col(n) for n in names]))


def earliest_by_patient(
    diagnoses: DataFrame,
    terms: DataFrame,
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    patients: DataFrame | None = None,
) -> DataFrame:
    """One row per patient: earliest guarded date and any unguarded event, per rule.

    The fact is scanned once for all rules. Dates are aggregated within each
    task before the shuffle on ``patient_key``, so a patient with very many
    events sends one row per task. ``patients``, which must be materialized,
    limits the work to known keys.
    """
    loads = [] if profile is None else [load_keys(profile, load_types)]
    known = [] if patients is None else [patients.select("patient_key")]
    small_terms, *others = are_small(terms, *known, *loads)
    hits = look_up(diagnoses, terms, "diagnosis_key", small_terms)
    if known:
        hits = of_patients(hits, known[0], others.pop(0))
    for keys, small in zip(loads, others):
        hits = keep_keys(hits, keys, small)
    marks = [c for c in terms.columns if c != "diagnosis_key"]
    return hits.groupBy("patient_key").agg(
        *[
            F.min(F.when(F.col(m), F.col("start_date_key"))).alias(m)
            if m.startswith("g_")
            else F.max(F.col(m).cast("int")).alias(m)
            for m in marks
        ]
    )


def history_flags(
    index: DataFrame,
    diagnoses: DataFrame,
    terminology: DataFrame,
    rules: Sequence[Rule],
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    case_sensitive: bool = False,
    settled: bool = False,
) -> DataFrame:
    """``index`` (one row per person) with a 0/1 column per rule.

    The row count is that of ``index``. A row without a person id gets zeros, as
    it could not be matched by person. Set ``settled`` when ``index`` is
    materialized: the fact is then cut down to the indexed patients before
    anything is aggregated.
    """
    terms = condition_terms(terminology, rules, case_sensitive)
    patients = index.select("patient_key") if settled else None
    earliest = earliest_by_patient(diagnoses, terms, profile, load_types, patients)

    def flag(rule: Rule) -> Column:
        present = F.lit(False)
        if rule.has_guarded:
            before = F.col("surgery_start_date_key") > F.col(f"g_{rule.name}")
            present = present | F.coalesce(before, F.lit(False))
        if rule.has_unguarded:
            present = present | F.coalesce(F.col(f"f_{rule.name}") == 1, F.lit(False))
        return (present & F.col("ir_id").isNotNull()).cast("int").alias(rule.name)

    return index.join(earliest, "patient_key", "left").select(
        *index.columns, *[flag(r) for r in rules]
    )


def covariate_matrix(
    index: DataFrame,
    diagnoses: DataFrame,
    terminology: DataFrame,
    rules: Sequence[Rule],
    profile: DataFrame | None = None,
    load_types: Sequence[str] | None = None,
    case_sensitive: bool = False,
    settled: bool = False,
) -> DataFrame:
    """One row per indexed person: age at the index date, race, gender, and flags."""
    flagged = history_flags(
        index.select(
            "ir_id",
            "patient_key",
            "birth_date",
            "race_1",
            "gender",
            "surgery_start_datetime",
            "surgery_start_date_key",
        ),
        diagnoses,
        terminology,
        rules,
        profile,
        load_types,
        case_sensitive,
        settled,
    )
    age = year_boundaries(F.col("birth_date"), F.col("surgery_start_datetime"))
    return flagged.select(
        "ir_id", age.alias("age"), "race_1", "gender", *[r.name for r in rules]
    )


def matrix_from_flags(index: DataFrame, flags: dict[str, DataFrame]) -> DataFrame:
    """The same matrix from separately built :func:`history_flag` results.

    Each set has one row per person, so the left joins keep the row count.
    Useful to combine flags of different sources; :func:`covariate_matrix` reads
    the fact once and is the one to use for many conditions on one fact.
    """
    joined = index
    for name, found in flags.items():
        mark = found.select("ir_id", F.col("condition").alias(f"_{name}"))
        joined = joined.join(mark, "ir_id", "left")
    age = year_boundaries(F.col("birth_date"), F.col("surgery_start_datetime"))
    return joined.select(
        "ir_id",
        age.alias("age"),
        "race_1",
        "gender",
        *[F.col(f"_{n}").isNotNull().cast("int").alias(n) for n in flags],
    )


def matrix_from_firsts(index: DataFrame, firsts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same matrix from one :func:`history_firsts` result, in one join."""
    marks = [
        F.max((F.col("condition") == rule.label).cast("int")).alias(rule.name) for rule in rules
    ]
    found = firsts.groupBy("ir_id").agg(*marks)
    age = year_boundaries(F.col("birth_date"), F.col("surgery_start_datetime"))
    flags = [F.coalesce(F.col(r.name), F.lit(0)).alias(r.name) for r in rules]
    return index.join(found, "ir_id", "left").select(
        "ir_id", age.alias("age"), "race_1", "gender", *flags
    )
