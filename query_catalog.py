"""Every registered query: (spark, folder) -> DataFrame over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import drugs, vocabulary
from cohortloom.functions.expressions import presence_flag, year_boundaries
from cohortloom.functions.rules import Branch, DrugClass, Rule
from cohortloom.operators.code_tables import rule_table, value_set_from_table
from cohortloom.operators.history import (
    covariate_matrix,
    history_firsts,
    history_flag,
    matrix_from_firsts,
)
from cohortloom.operators.index import first_event, index_events
from cohortloom.operators.materialize import ensure_checkpoint_dir, settle
from cohortloom.operators.medications import (
    classify_medications,
    cohort_members,
    medication_exposure,
)
from cohortloom.operators.numbering import global_row_number
from cohortloom.operators.ordering import file_violations
from cohortloom.operators.outcomes import events_for, label_outcomes, within_window
from cohortloom.operators.profiles import merge_profiles, profile, profile_state
from cohortloom.operators.sizing import are_small, broadcast_small, keep_keys
from cohortloom.operators.states import update_first_events
from cohortloom.operators.value_sets import distinct_values, load_keys, point_lookup, value_set
from cohortloom.operators.windows import events_in_windows
from cohortloom.plans.studies import (
    TIE_BREAK,
    drug_exposure,
    surgery_history,
    surgery_outcomes,
)
from cohortloom.sources import (
    Warehouse,
    between_days,
    create_database,
    read_csv,
    replace_view,
    save_table,
    with_year,
    write_csv,
)
from cohortloom.sources.versions import read_version, stage, write_version
from fixture_views import Analogue, clinical_warehouse

TYPES = ("PROMO", "ECONOMY", "SMALL")
BRANDS = ("Brand#1", "Brand#7", "Brand#13", "Brand#19")
LOADS = ("1-URGENT", "2-HIGH")
STATUSES = ("F", "O")
WINDOW_DAYS = 30

STRING_RANGE = Rule("string_range", (Branch(base_between=("Brand#10", "Brand#12")),))
_PAIRS = (
    Branch(code_sets=("LARGE",), codes=("Brand#2", "Brand#3")),
    Branch(code_sets=("MEDIUM",), codes=("Brand#4",)),
)
CODE_PAIRS = Rule("code_pairs", _PAIRS)
LAST_BRANCH = Rule("last_branch", _PAIRS, guard_scope="last_branch")
NAME_LIKE = Rule("name_like", (Branch(name_like=("%re%ing%",)), Branch(code_prefix="Brand#2")))
MATRIX_RULES = (STRING_RANGE, CODE_PAIRS, LAST_BRANCH, NAME_LIKE)
OUTCOME = Rule(
    "outcome",
    (
        Branch(code_sets=("LARGE",), codes=("Brand#5", "Brand#8", "Brand#11")),
        Branch(code_sets=("STANDARD",), bases=("Brand#6", "Brand#9", "Brand#14")),
    ),
)
PATTERN_CLASSES = (
    DrugClass("a", brand=("%ring%", "red%"), generic=("PRO%",)),
    DrugClass("b", brand=("%re% ring", "small%")),
    DrugClass("c", brand=("hot bolt",)),
    DrugClass("d", brand=("%bolt",)),
    DrugClass("e", generic=("LARGE", "%AND%")),
    DrugClass("f", either=("%old%",)),
    DrugClass("g", brand=("%BLUE%",)),
)

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


def portable(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as text, which every engine prints alike."""
    picked = df.select(*columns) if columns else df
    temporal = [c for c, t in picked.dtypes if t in ("date", "timestamp_ntz", "timestamp")]
    return picked.withColumns({c: F.col(c).cast("string") for c in temporal}) if temporal else picked


# -- index events --------------------------------------------------------------


def analogue_events(a: Analogue, patients: DataFrame | None = None) -> DataFrame:
    return index_events(
        a.procedures,
        a.procedure_dim,
        a.patients if patients is None else patients,
        TYPES,
        BRANDS,
        encounters=a.encounters,
    )


def analogue_index(a: Analogue, patients: DataFrame | None = None) -> DataFrame:
    return first_event(analogue_events(a, patients), "ir_id", "surgery_start_datetime", TIE_BREAK)


EVENT_COLUMNS = (
    "surgical_case_key",
    "ir_id",
    "patient_key",
    "visit_key",
    "procedure_name",
    "surgery_start_datetime",
    "surgery_start_date_key",
    "surgery_end_datetime",
    "surgery_end_date_key",
    "discharge_datetime",
    "race_1",
    "gender",
)


@query
def index_events_by_code(spark, folder):
    return portable(analogue_events(Analogue(spark, folder)), *EVENT_COLUMNS)


@query
def index_events_without_encounter(spark, folder):
    a = Analogue(spark, folder)
    events = index_events(a.procedures, a.procedure_dim, a.patients, TYPES, BRANDS)
    return portable(
        events, "surgical_case_key", "ir_id", "encounter_inpatient_key", "surgery_start_datetime"
    )


@query
def index_events_normalized_name(spark, folder):
    warehouse = clinical_warehouse(spark, folder)
    events = index_events(
        warehouse.view("coded_procedure"),
        warehouse.view("procedure"),
        warehouse.view("patient"),
        vocabulary.PROCEDURE_CODE_TYPES,
        vocabulary.BYPASS_CODES,
        encounters=warehouse.view("encounter_inpatient"),
    )
    return portable(events, "surgical_case_key", "procedure_name", "surgery_start_datetime")


@query
def index_first_by_date(spark, folder):
    return portable(analogue_index(Analogue(spark, folder)), *EVENT_COLUMNS)


@query
def index_first_by_name(spark, folder):
    tie_break = ("surgery_start_datetime", *TIE_BREAK)
    events = analogue_events(Analogue(spark, folder))
    first = first_event(events, "ir_id", "procedure_name", tie_break)
    return portable(first, "ir_id", "procedure_name", "surgical_case_key", "surgery_start_datetime")


@query
def person_multi_key_index(spark, folder):
    """A nation is one person, its customers are that person's patient keys."""
    a = Analogue(spark, folder)
    nations = a.table("customer").select(
        F.col("c_custkey").alias("patient_key"), F.col("c_nationkey").alias("nation")
    )
    patients = a.patients.join(nations, "patient_key").withColumn("ir_id", F.col("nation"))
    first = analogue_index(a, patients)
    return portable(first, "ir_id", "patient_key", "surgical_case_key", "surgery_start_datetime")


@query
def global_row_number_of_events(spark, folder):
    events = analogue_events(Analogue(spark, folder)).select(
        "ir_id", "surgery_start_datetime", "surgical_case_key"
    )
    order = ("ir_id", "surgery_start_datetime", "surgical_case_key")
    return portable(global_row_number(events, order, distinct=True))


@query
def index_events_from_code_table(spark, folder):
    """The code list is a table: types and brands, together, of parts of one size."""
    a = Analogue(spark, folder)
    listed = a.table("part").where(F.col("p_size") == 7)
    codes = listed.select(F.col("p_type").alias("code_type"), F.col("p_brand").alias("procedure_code"))
    events = index_events(a.procedures, a.procedure_dim, a.patients, None, codes.distinct())
    return portable(events, "surgical_case_key", "ir_id", "procedure_name", "surgery_start_datetime")


# -- value sets and outcomes ---------------------------------------------------


@query
def value_sets_from_table(spark, folder):
    """The nine conditions as rows of a rule table, looked up in one join."""
    terminology = clinical_warehouse(spark, folder).view("diagnosis_terminology")
    rules = (vocabulary.AF_OUTCOME, *vocabulary.HISTORY_CONDITIONS)
    return value_set_from_table(terminology, rule_table(spark, rules))


@query
def value_set_keys(spark, folder):
    return value_set(Analogue(spark, folder).terminology, OUTCOME)


def analogue_outcomes(spark, folder) -> tuple[DataFrame, DataFrame]:
    a = Analogue(spark, folder)
    index = settle(
        analogue_index(a).select(
            "surgical_case_key", "ir_id", "patient_key", "visit_key", "surgery_start_datetime"
        )
    )
    keys = value_set(a.terminology, OUTCOME)
    return index, events_for(index, a.diagnoses, keys, a.profile, LOADS, settled=True)


LABEL_COLUMNS = (
    "surgical_case_key",
    "ir_id",
    "patient_key",
    "visit_key",
    "surgery_start_datetime",
    "outcome_datetime",
)


@query
def outcome_events(spark, folder):
    return portable(analogue_outcomes(spark, folder)[1])


@query
def outcome_labels(spark, folder):
    index, events = analogue_outcomes(spark, folder)
    return portable(
        label_outcomes(index, events, LABEL_COLUMNS, label="outcome_datetime", settled=True)
    )


@query
def outcome_in_window(spark, folder):
    index, events = analogue_outcomes(spark, folder)
    length = F.make_dt_interval(F.lit(WINDOW_DAYS))
    index = index.withColumn("discharge_datetime", F.col("surgery_start_datetime") + length)
    labelled = label_outcomes(
        index,
        events,
        (*LABEL_COLUMNS, "discharge_datetime"),
        label="outcome_datetime",
        ordered=False,
        settled=True,
    )
    return portable(within_window(labelled, event="outcome_datetime"), *LABEL_COLUMNS)


# -- history -------------------------------------------------------------------

HISTORY_COLUMNS = ("ir_id", "start_date_key", "diagnosis_event_key", "diagnosis_code", "condition")


def analogue_history(spark, folder, rule: Rule) -> DataFrame:
    a = Analogue(spark, folder)
    found = history_flag(analogue_index(a), a.diagnoses, a.terminology, rule, a.profile, LOADS)
    return portable(found, *HISTORY_COLUMNS)


@query
def history_string_range(spark, folder):
    return analogue_history(spark, folder, STRING_RANGE)


@query
def history_code_pairs(spark, folder):
    return analogue_history(spark, folder, CODE_PAIRS)


@query
def history_guard_last_branch(spark, folder):
    return analogue_history(spark, folder, LAST_BRANCH)


@query
def history_like(spark, folder):
    return analogue_history(spark, folder, NAME_LIKE)


@query
def covariates(spark, folder):
    """The flagship: one row per indexed person from one pass over the facts."""
    a = Analogue(spark, folder)
    index = settle(
        analogue_index(a, a.patients_with_birth).select(
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
        index, a.diagnoses, a.terminology, MATRIX_RULES, a.profile, LOADS, settled=True
    )


@query
def covariates_from_flags(spark, folder):
    """The same matrix, put together from the earliest events of all conditions."""
    a = Analogue(spark, folder)
    index = settle(analogue_index(a, a.patients_with_birth))
    firsts = history_firsts(
        index, a.diagnoses, a.terminology, MATRIX_RULES, a.profile, LOADS, settled=True
    )
    return matrix_from_firsts(index, firsts, MATRIX_RULES)


@query
def age_boundary_years(spark, folder):
    a = Analogue(spark, folder)
    index = analogue_index(a, a.patients_with_birth)
    age = year_boundaries(F.col("birth_date"), F.col("surgery_start_datetime"))
    return portable(index.select("ir_id", "birth_date", "surgery_start_datetime", age.alias("age")))


@query
def presence_flags(spark, folder):
    """Each customer with a 0/1 flag: any order of the highest priority."""
    a = Analogue(spark, folder)
    urgent = a.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    urgent = urgent.select(F.col("o_custkey").alias("c_custkey"), F.lit("urgent").alias("urgent"))
    customers = a.table("customer").select("c_custkey")
    return customers.join(urgent.distinct(), "c_custkey", "left").select(
        "c_custkey", presence_flag(F.col("urgent")).alias("has_urgent")
    )


# -- medications and cohort ----------------------------------------------------


def analogue_exposure(spark, folder, case_sensitive: bool) -> DataFrame:
    a = Analogue(spark, folder)
    listed = a.table("customer").where(F.col("c_acctbal") > 0)
    person_ids = listed.select(F.col("c_custkey").alias("ir_id"))
    exposure = medication_exposure(
        a.medications,
        a.medication_orders,
        a.order_profile,
        cohort_members(a.patients, person_ids),
        a.patients,
        PATTERN_CLASSES,
        STATUSES,
        case_sensitive=case_sensitive,
    )
    return portable(exposure)


@query
def exposure_by_class(spark, folder):
    return analogue_exposure(spark, folder, case_sensitive=True)


@query
def exposure_case_insensitive(spark, folder):
    return analogue_exposure(spark, folder, case_sensitive=False)


@query
def cohort_semi_join(spark, folder):
    """Orders of the listed customers."""
    a = Analogue(spark, folder)
    listed = a.table("customer").where(F.col("c_acctbal") > 9000)
    keys = listed.select(F.col("c_custkey").alias("o_custkey"))
    orders = a.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    (keys,) = broadcast_small(keys)
    return portable(orders.join(keys, "o_custkey", "left_semi"))


@query
def distinct_profile(spark, folder):
    return distinct_values(Analogue(spark, folder).terminology, "diagnosis_code_set")


@query
def point_lookup_of_person(spark, folder):
    """One person's orders; the id is given as text."""
    orders = Analogue(spark, folder).table("orders")
    found = point_lookup(orders, "o_custkey", "123")
    return portable(found, "o_orderkey", "o_custkey", "o_orderdate")


# -- the three studies on views with real codes and drug names -------------------


@query
def study_outcomes(spark, folder):
    labelled = surgery_outcomes(clinical_warehouse(spark, folder))
    return portable(labelled.withColumn("ir_id", F.col("ir_id").cast("string")))


@query
def study_outcomes_during_stay(spark, folder):
    labelled = surgery_outcomes(clinical_warehouse(spark, folder), during_stay=True)
    return portable(labelled)


@query
def study_history(spark, folder):
    matrix = surgery_history(clinical_warehouse(spark, folder))
    return matrix.withColumn("ir_id", F.col("ir_id").cast("string"))


@query
def study_exposure(spark, folder):
    return portable(clinical_exposure(spark, folder))


@query
def study_exposure_case_sensitive(spark, folder):
    return portable(clinical_exposure(spark, folder, case_sensitive=True))


def clinical_exposure(spark, folder, case_sensitive: bool = False) -> DataFrame:
    warehouse = clinical_warehouse(spark, folder)
    listed = load_ids(spark, folder)
    exposure = drug_exposure(warehouse, listed, case_sensitive=case_sensitive)
    return exposure


def load_ids(spark, folder) -> DataFrame:
    """Person ids as given by a caller: persons of customers in credit."""
    customers = Analogue(spark, folder).table("customer").where(F.col("c_acctbal") > 0)
    person = F.col("c_custkey") + F.col("c_custkey") % 2
    return customers.select(person.alias("ir_id")).distinct()


@query
def study_classified_medications(spark, folder):
    medications = clinical_warehouse(spark, folder).view("medication")
    return classify_medications(medications, drugs.DRUG_CLASSES)


@query
def study_first_history_events(spark, folder):
    """Earliest event of every condition; undated ones come first where they count."""
    warehouse = clinical_warehouse(spark, folder)
    surgeries = index_events(
        warehouse.view("coded_procedure"),
        warehouse.view("procedure"),
        warehouse.view("patient"),
        vocabulary.PROCEDURE_CODE_TYPES,
        vocabulary.BYPASS_CODES,
    )
    tie_break = ("surgery_start_datetime", *TIE_BREAK)
    index = first_event(surgeries, "ir_id", "procedure_name", tie_break)
    found = history_firsts(
        settle(index.select("ir_id", "patient_key", "surgery_start_date_key")),
        warehouse.view("diagnosis_event"),
        warehouse.view("diagnosis_terminology"),
        vocabulary.HISTORY_CONDITIONS,
        warehouse.view("diagnosis_event_profile"),
        vocabulary.ACCEPTED_LOAD_TYPES,
        settled=True,
    )
    return portable(found, *HISTORY_COLUMNS)


@query
def catalog_view_by_name(spark, folder):
    """Patients through a name in the session's catalog, as a warehouse reads them."""
    clinical_warehouse(spark, folder).view("patient").createOrReplaceTempView("vw_patient")
    warehouse = Warehouse.from_catalog(spark, {"patient": "vw_patient"})
    return portable(warehouse.view("patient").select("patient_key", "ir_id", "race_1", "gender"))


@query
def named_intermediate_replaced(spark, folder):
    """A named intermediate, written over, then read by SQL."""
    orders = Analogue(spark, folder).table("orders")
    replace_view(orders.where(F.col("o_orderstatus") == "P"), "stage_orders")
    replace_view(orders.where(F.col("o_orderstatus") == "F"), "stage_orders")
    return spark.sql("SELECT o_custkey, count(*) AS n FROM stage_orders GROUP BY o_custkey")


# -- saved results and intermediates ---------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """A new name in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/saved-{uuid.uuid4().hex}"


@query
def csv_written_and_read(spark, folder):
    """Orders with awkward texts, written as CSV with a manifest and read back by type."""
    kind = F.col("o_orderkey") % 8
    text = (
        F.when(kind == 1, "")
        .when(kind == 2, F.concat(F.lit('"'), "o_orderpriority", F.lit('", said')))
        .when(kind == 3, F.concat(F.lit(" two\nlines "), "o_orderstatus", F.lit(" ")))
        .when(kind == 4, "\\")
        .when(kind > 4, F.col("o_orderpriority"))
    )
    written = Analogue(spark, folder).table("orders").select(
        "o_orderkey", "o_custkey", text.alias("note"), "o_totalprice", "o_orderdate", F.col("o_orderdate").cast("date").alias("day")
    )
    path = shared_folder(spark)
    write_csv(written, path, manifest=True)
    return portable(read_csv(spark, path, verify=True))


def saved_warehouse(spark, folder) -> Warehouse:
    """Views saved as catalog tables, the fact partitioned by year, under names of two and three parts."""
    warehouse = clinical_warehouse(spark, folder)
    database = create_database(spark, f"dw_{uuid.uuid4().hex}", shared_folder(spark))
    save_table(warehouse.view("patient"), f"{database}.vw_patient")
    events = with_year(warehouse.view("diagnosis_event"), "start_date_key")
    save_table(events, f"spark_catalog.{database}.vw_diagnosis_event", partition_by=["start_date_key_year"])
    names = {"patient": f"{database}.vw_patient", "diagnosis_event": f"spark_catalog.{database}.vw_diagnosis_event"}
    return Warehouse.from_catalog(spark, names)


@query
def catalog_tables_by_part_names(spark, folder):
    """Diagnoses of one year and their persons; the other years' files are not read."""
    warehouse = saved_warehouse(spark, folder)
    events = between_days(warehouse.view("diagnosis_event"), "start_date_key", date(1995, 3, 1), date(1995, 12, 31))
    found = events.join(warehouse.view("patient").select("patient_key", "ir_id", "gender"), "patient_key")
    return portable(found, "diagnosis_event_key", "patient_key", "ir_id", "gender", "start_date_key")


def bucketed(spark, facts: DataFrame) -> DataFrame:
    """A fact saved in buckets of patients."""
    database = create_database(spark, f"facts_{uuid.uuid4().hex}", shared_folder(spark))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return save_table(facts, f"{database}.fact", buckets=buckets, bucket_by=["patient_key"])


@query
def covariates_on_bucketed_facts(spark, folder):
    """The covariate matrix; the diagnosis fact is bucketed by patient, so it is not exchanged."""
    a = Analogue(spark, folder)
    index = settle(analogue_index(a, a.patients_with_birth))
    facts = bucketed(spark, a.diagnoses)
    return covariate_matrix(index, facts, a.terminology, MATRIX_RULES, a.profile, LOADS, settled=True)


# -- all windows, large key sets -------------------------------------------------


@query
def outcomes_in_windows_of_all_events(spark, folder):
    """Outcome events within 30 days from any of the patient's index events, not just the first."""
    a = Analogue(spark, folder)
    length = F.make_dt_interval(F.lit(WINDOW_DAYS))
    windows = analogue_events(a).select(
        "surgical_case_key", "patient_key", "surgery_start_datetime", (F.col("surgery_start_datetime") + length).alias("until")
    )
    keys, loads = value_set(a.terminology, OUTCOME), load_keys(a.profile, LOADS)
    hits = a.diagnoses
    for side, small in zip((keys, loads), are_small(keys, loads)):
        hits = keep_keys(hits, side, small)
    hits = hits.select("patient_key", "diagnosis_event_key", "start_datetime")
    found = events_in_windows(windows, hits, "surgery_start_datetime", "until", "start_datetime")
    return portable(found.drop("until"))


@query
def cohort_semi_join_of_many_keys(spark, folder):
    """Orders of the listed customers as for keys too many to broadcast: filtered, then shuffled."""
    a = Analogue(spark, folder)
    listed = a.table("customer").where(F.col("c_acctbal") > 9000)
    keys = listed.select(F.col("c_custkey").alias("o_custkey"))
    orders = a.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return portable(keep_keys(orders, keys, small=False))


# -- versions, order, profiles, states ---------------------------------------------


@query
def committed_version_read(spark, folder):
    """Orders by status written twice; readers see the version committed last."""
    orders = Analogue(spark, folder).table("orders")
    path = shared_folder(spark)
    for status in ("P", "F"):
        counted = orders.where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        write_version(counted, path, status)
    again = stage(spark, path, "F", lambda: orders.select("o_custkey", F.lit(0).alias("n")))  # is there, so not built
    return read_version(spark, path).intersectAll(again)


@query
def study_outcomes_in_order(spark, folder):
    """The sorted study result written as CSV: its rows, and places where the files are out of order."""
    labelled = surgery_outcomes(clinical_warehouse(spark, folder))
    path = shared_folder(spark)
    write_csv(labelled, path, manifest=True)
    order = ["ir_id", "surgery_start_datetime", "AF_dxDate", "surgical_case_key"]
    return file_violations(read_csv(spark, path), order).select("n_rows", "violations")


@query
def column_profiles(spark, folder):
    """Profiles of parts and nations; the parts' from states of two halves."""
    a = Analogue(spark, folder)
    parts = a.table("part").select("p_type", "p_brand", "p_size")
    halves = [profile_state(parts.where(c)) for c in (F.col("p_size") <= 25, F.col("p_size") > 25)]
    nations = profile_state(a.table("nation").select("n_nationkey", "n_name", "n_regionkey"))
    shown = ["column_name", "n_rows", "n_nulls", "n_distinct", "least", "greatest"]
    of_parts = profile(merge_profiles(*halves, numbers=["p_size"])).select(*shown, F.lit(None).cast("double").alias("median"))
    return of_parts.unionAll(profile(nations).select(*shown, F.get("quantiles", F.lit(0)).alias("median")))


@query
def first_events_kept_up_to_date(spark, folder):
    """The first event of each person from a state that three lots of facts were merged into."""
    events = analogue_events(Analogue(spark, folder)).select("surgical_case_key", "ir_id", "procedure_name", "surgery_start_datetime")
    path = shared_folder(spark)
    lot = F.pmod(F.xxhash64("surgical_case_key"), F.lit(3))
    for number in range(3):
        state = update_first_events(spark, path, events.where(lot == number), "ir_id", "surgery_start_datetime", "surgical_case_key")
    return portable(state)
