"""Shape of the physical plans, and results under skew and without broadcasts."""

from datetime import date, datetime, timedelta

import pytest
from plan_tools import final_plan, plan_text
from pyspark.sql import functions as F

import query_catalog as q
from cohortloom.functions.rules import Branch, DrugClass, Rule
from cohortloom.operators import sizing
from cohortloom.operators.history import covariate_matrix, history_firsts, history_flag
from cohortloom.operators.index import first_event
from cohortloom.operators.materialize import ensure_checkpoint_dir, settle
from cohortloom.operators.medications import ORDER_TIMES, medication_exposure
from cohortloom.operators.numbering import global_row_number
from cohortloom.operators.outcomes import events_for, label_outcomes
from cohortloom.operators.value_sets import value_set
from cohortloom.plans.studies import drug_exposure, surgery_history, surgery_outcomes
from fixture_views import clinical_warehouse

FOLDER = "/root/testdata/sf0.001"


def fact_scans(text: str) -> int:
    return sum("FileScan" in line and "l_orderkey" in line for line in text.splitlines())


def test_first_event_limits_groups_before_the_shuffle(spark):
    text = plan_text(q.CATALOG["index_first_by_date"](spark, FOLDER))
    final, rest = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert final < text.index("Exchange hashpartitioning(ir_id") < rest
    assert "row_number(), 1, Partial" in text


ONE_SCAN = [
    "covariates", "covariates_from_flags", "study_history", "study_first_history_events",
    "study_exposure", "study_outcomes", "outcome_labels",
]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_fact_is_scanned_once(spark, name):
    text = final_plan(q.CATALOG[name](spark, FOLDER))
    assert fact_scans(text) == 1


def test_value_set_filter_reaches_the_fact_scan(spark):
    """The key filter sits below the join of line items and orders."""
    lines = plan_text(q.CATALOG["covariates"](spark, FOLDER)).splitlines()
    scan = next(i for i, l in enumerate(lines) if "FileScan" in l and "l_orderkey" in l)
    above = [l for l in lines[:scan] if "Join" in l][-1]
    assert "LeftSemi" in above and "l_partkey" in above


def test_only_needed_columns_are_read(spark):
    text = plan_text(q.CATALOG["covariates"](spark, FOLDER))
    assert "l_quantity" not in text and "o_totalprice" not in text


def test_few_jobs_run_while_outcomes_are_planned(spark):
    group = "plan of study_outcomes"
    spark.sparkContext.setJobGroup(group, group)
    try:
        q.CATALOG["study_outcomes"](spark, FOLDER)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 14


def test_result_types_of_the_studies(spark):
    warehouse = clinical_warehouse(spark, FOLDER)
    person = [("ir_id", "bigint")]
    assert surgery_outcomes(warehouse).dtypes == [
        ("surgical_case_key", "string"), *person, ("patient_key", "bigint"), ("visit_key", "bigint"),
        ("surgery_start_datetime", "timestamp_ntz"), ("AF_dxDate", "timestamp_ntz"),
        ("discharge_datetime", "timestamp_ntz"),
    ]
    flags = ["smoking", "copd", "prior_af", "hypertension", "diabetes", "mitralValve", "hf", "myo"]
    assert surgery_history(warehouse).dtypes == [
        *person, ("age", "int"), ("race_1", "string"), ("gender", "string"), *((f, "int") for f in flags),
    ]
    exposure = drug_exposure(warehouse, q.load_ids(spark, FOLDER))
    assert exposure.dtypes == [
        ("med_class", "string"), ("medication_key", "bigint"), ("medication_name", "string"),
        ("generic_name", "string"), *((c, "timestamp_ntz") for c in ORDER_TIMES),
        ("patient_key", "bigint"), *person,
    ]


@pytest.mark.parametrize("name", sorted(q.CATALOG))
def test_no_row_by_row_python_and_no_cross_join(spark, name):
    text = plan_text(q.CATALOG[name](spark, FOLDER))
    assert "Python" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_global_row_number_uses_no_single_partition(spark):
    frame = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") % 10).alias("person"), F.when(F.col("id") > 5, F.col("id")).alias("day"), "id"
    )
    numbered = global_row_number(frame, ["person", "day", "id"])
    assert "SinglePartition" not in plan_text(numbered)
    found = [tuple(r) for r in numbered.orderBy("the_counter").collect()]
    expected = sorted(
        ((i % 10, i if i > 5 else None, i) for i in range(5000)),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]),
    )
    assert found == [(*r, n) for n, r in enumerate(expected, start=1)]


def test_global_row_number_of_nothing_and_of_duplicates(spark):
    empty = spark.createDataFrame([], "a long")
    assert global_row_number(empty, ["a"]).collect() == []
    twice = spark.createDataFrame([(1,), (1,), (2,)], "a long")
    assert global_row_number(twice, ["a"]).count() == 3
    distinct = global_row_number(twice, ["a"], name="n", distinct=True)
    assert sorted(tuple(r) for r in distinct.collect()) == [(1, 1), (2, 2)]


def test_settle_uses_the_configured_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") in folder
    settled = settle(spark.range(10).selectExpr("id * 2 AS x"))
    assert "Range" not in plan_text(settled)
    assert settled.agg(F.sum("x")).first()[0] == 90


def test_sides_are_broadcast_by_measured_size_only(spark):
    frame = spark.createDataFrame([(n, "x" * 100) for n in range(50)], "k long, t string")
    nested = frame.select(F.array("k").alias("a"))
    sizes = sizing.measured_bytes(frame, nested, frame.limit(0))
    assert sizes == [50 * (32 + 8 + 8 + 100), None, 0]
    assert sizing.measured_bytes(nested) == [None]
    assert sizing.are_small(frame, nested) == [True, False]
    fact = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        (hinted,) = sizing.broadcast_small(frame)
        (plain,) = sizing.broadcast_small(frame, limit=100)
        assert "BroadcastHashJoin" in plan_text(fact.join(hinted, "k", "left_semi"))
        assert "BroadcastHashJoin" not in plan_text(fact.join(plain, "k", "left_semi"))
        small, large = (sizing.look_up(fact, frame, "k", s) for s in (True, False))
        assert "SortMergeJoin" in plan_text(large) and "SortMergeJoin" not in plan_text(small)
        assert sorted(small.collect()) == sorted(large.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- one patient with a third of all events ----------------------------------------

RULES = (
    Rule("early", (Branch(codes=("a",)),)),
    Rule("mixed", (Branch(codes=("b",)), Branch(codes=("c",))), guard_scope="last_branch"),
)
START = datetime(2015, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 events; patient 0 has 20,000, the others about 40 each."""
    n = F.col("id")
    events = spark.range(0, 60000, numPartitions=16).select(
        n.alias("diagnosis_event_key"),
        F.when(n % 3 == 0, 0).otherwise(n % 1000).alias("patient_key"),
        (F.xxhash64(n) % 4 + 4).alias("diagnosis_key"),
        F.lit(1).cast("long").alias("diagnosis_event_profile_key"),
        (F.lit(START) + F.make_dt_interval(n % 4000)).cast("timestamp_ntz").alias("start_datetime"),
    )
    events = events.withColumn("start_date_key", F.col("start_datetime").cast("date"))
    terms = spark.createDataFrame(
        [(k, "s", "abcd"[k % 4], "abcd"[k % 4], None) for k in range(1, 8)],
        "diagnosis_key long, diagnosis_code_set string, diagnosis_code string, "
        "diagnosis_code_base string, diagnosis_name string",
    )
    index = spark.range(0, 1000, numPartitions=4).select(
        n.alias("surgical_case_key"),
        n.alias("ir_id"),
        n.alias("patient_key"),
        n.alias("visit_key"),
        F.lit(date(1950, 1, 1)).alias("birth_date"),
        F.lit("r").alias("race_1"),
        F.lit("g").alias("gender"),
        (F.lit(START) + F.make_dt_interval(n * 2)).cast("timestamp_ntz").alias("surgery_start_datetime"),
    )
    index = index.withColumn(
        "surgery_start_date_key", F.col("surgery_start_datetime").cast("date")
    ).withColumn("discharge_datetime", F.col("surgery_start_datetime") + F.make_dt_interval(F.lit(30)))
    return settle(events), settle(terms), settle(index)


@pytest.fixture
def splitting(spark, monkeypatch):
    """No broadcasts, and skew thresholds that small data can cross."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def expected_events(skewed):
    events, terms, index = (f.collect() for f in skewed)
    codes = {t.diagnosis_key: t.diagnosis_code for t in terms}
    return [(e, codes[e.diagnosis_key]) for e in events], {i.patient_key: i for i in index}


def test_skewed_outcome_labels(spark, skewed, splitting):
    events, terms, index = skewed
    found = events_for(index, events, value_set(terms, RULES[0]))
    text = final_plan(found)
    assert "BroadcastHashJoin" not in text
    assert text.count("skew=true") == 2  # the diagnosis keys and the patient
    labelled = label_outcomes(index, found)
    text = final_plan(labelled)
    assert "ReusedExchange" in text and "skew=true" in text
    coded, people = expected_events(skewed)
    dates = {(e.patient_key, e.start_datetime) for e, code in coded if code == "a"}
    unlabelled = set(people) - {p for p, _ in dates}
    expected = sorted(dates, key=str) + [(p, None) for p in sorted(unlabelled)]
    result = [(r.ir_id, r.AF_dxDate) for r in labelled.collect()]
    assert sorted(result, key=str) == sorted(expected, key=str)
    assert [p for p, _ in result] == sorted(p for p, _ in result)


def test_skewed_history(spark, skewed, splitting):
    events, terms, index = skewed
    coded, people = expected_events(skewed)
    early, mixed = set(), set()
    for e, code in coded:
        before = e.start_date_key < people[e.patient_key].surgery_start_date_key
        if code == "a" and before:
            early.add(e.patient_key)
        if code == "b" or (code == "c" and before):
            mixed.add(e.patient_key)
    matrix = covariate_matrix(index, events, terms, RULES, settled=True)
    result = {r.ir_id: (r.early, r.mixed) for r in matrix.collect()}
    assert result == {p: (int(p in early), int(p in mixed)) for p in people}
    # The hot patient is aggregated in every task before the shuffle.
    text = final_plan(matrix)
    assert "partial_min" in text
    flagged = history_flag(index, events, terms, RULES[1])
    assert {r.ir_id for r in flagged.collect()} == mixed
    assert "row_number(), 1, Partial" in plan_text(flagged)
    limited = history_firsts(index, events, terms, RULES, settled=True)
    text = final_plan(limited)
    assert "LeftSemi" in text and "skew=true" in text  # the fact's hot patient
    found = {(r.ir_id, r.condition) for r in limited.collect()}
    assert found == {(p, "early") for p in early} | {(p, "mixed") for p in mixed}


def test_skewed_exposure(spark, splitting):
    """One patient and one medication hold a third of the orders each."""
    n = F.col("id")
    moment = (F.lit(START) + F.make_dt_interval(n % 20011)).cast("timestamp_ntz")
    orders = settle(
        spark.range(0, 60000, numPartitions=16).select(
            F.when(n % 3 == 0, 1).otherwise(n % 200 + 1).alias("medication_key"),
            F.when(n % 3 == 1, 0).otherwise(n % 1000).alias("patient_key"),
            (n % 7).alias("medication_order_profile_key"),
            *[moment.alias(c) for c in ORDER_TIMES],
        )
    )
    medications = settle(
        spark.range(1, 201).select(
            n.alias("medication_key"),
            F.concat(F.lit("Lipitor "), n % 2, F.lit(" mg "), n).alias("medication_name"),
            F.lit("aspirin").alias("generic_name"),
        )
    )
    profile = settle(
        spark.range(7).select(
            n.alias("medication_order_profile_key"),
            F.when(n < 6, "Sent").otherwise("Cancelled").alias("order_status"),
        )
    )
    patients = settle(spark.range(1000).select(n.alias("patient_key"), (n * 10).alias("ir_id")))
    classes = (DrugClass("odd", brand=("%1 mg%",)), DrugClass("any", generic=("aspirin",)))
    exposure = medication_exposure(
        medications, orders, profile, patients.where("ir_id < 9000"), patients, classes, ["Sent"]
    )
    found = {
        (r.med_class, r.medication_key, r.order_start_datetime, r.patient_key, r.ir_id)
        for r in exposure.collect()
    }
    expected = set()
    for o in orders.collect():
        if o.medication_order_profile_key < 6 and o.patient_key < 900:
            row = (o.medication_key, o.order_start_datetime, o.patient_key, o.patient_key * 10)
            expected.add(("any", *row))
            if o.medication_key % 2:
                expected.add(("odd", *row))
    assert found == expected
    assert exposure.count() == len(expected)
    text = final_plan(exposure)
    assert "BroadcastHashJoin" not in text
    # The hot profile key, the hot patient and the hot medication.
    assert text.count("skew=true") == 3


def test_skewed_first_event(spark, skewed):
    events, _, _ = skewed
    first = first_event(events, "patient_key", "start_datetime", "diagnosis_event_key")
    expected = {}
    for e in events.collect():
        key = (e.start_datetime, e.diagnosis_event_key)
        expected[e.patient_key] = min(expected.get(e.patient_key, key), key)
    found = {r.patient_key: (r.start_datetime, r.diagnosis_event_key) for r in first.collect()}
    assert found == expected
