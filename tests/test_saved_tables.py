"""Tables saved by name: partition pruning, buckets without exchange; filters of large key sets."""

import re
from datetime import date

import pytest
from clinic import rows
from plan_tools import final_plan
from pyspark.sql import functions as F

from cohortloom.operators import sizing
from cohortloom.operators.history import earliest_by_patient, history_firsts
from cohortloom.operators.medications import medication_exposure
from cohortloom.operators.outcomes import events_for
from cohortloom.operators.sizing import key_filter, keep_keys, may_have_key
from cohortloom.operators.value_sets import value_set
from cohortloom.sources import Warehouse, between_days, create_database, load_table, save_table, with_year
from query_catalog import MATRIX_RULES, OUTCOME, PATTERN_CLASSES, analogue_index
from fixture_views import Analogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path):
    name = create_database(spark, f"saved_{abs(hash(str(tmp_path)))}", str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def days(spark):
    return spark.range(4000).select(
        F.col("id").alias("event"), F.when(F.col("id") % 10 != 0, F.date_add(F.lit(date(1990, 1, 1)), F.col("id").cast("int"))).alias("day")
    )


def test_only_the_asked_years_are_read(spark, database):
    saved = save_table(with_year(days(spark), "day"), f"spark_catalog.{database}.events", partition_by=["day_year"])
    found = between_days(load_table(spark, f"{database}.events"), "day", date(1992, 5, 1), date(1993, 2, 1))
    expected = days(spark).where(F.col("day").between(date(1992, 5, 1), date(1993, 2, 1)))
    assert rows(found.select("event", "day")) == rows(expected) != []
    assert "PartitionFilters: [isnotnull(day_year" in final_plan(found)
    folders = {r[0] for r in found.select(F.regexp_extract(F.input_file_name(), "day_year=([^/]*)", 1)).distinct().collect()}
    assert folders == {"1992", "1993"}
    assert saved.where("day IS NULL").count() == 400  # undated rows have a folder of their own
    plain = between_days(days(spark), "day", date(1992, 5, 1), date(1993, 2, 1))
    assert rows(plain) == rows(expected)


def test_a_rerun_replaces_a_table(spark, database):
    name = f"{database}.stage"
    save_table(spark.range(10), name)
    assert save_table(spark.range(3), name).count() == load_table(spark, "stage", database=database).count() == 3
    with pytest.raises(ValueError, match="go together"):
        save_table(spark.range(3), name, buckets=4)


def fact_exchanges(plan: str, table: str) -> list[str]:
    """Exchanges between the scan of a table and the root."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if table in line and "Scan" in line)
    depth, found = len(lines[at]), []
    level = re.search(r"[A-Za-z(*]", lines[at]).start()
    for line in reversed(lines[:at]):
        start = re.search(r"[A-Za-z(*]", line)
        if start and start.start() < level:
            level = start.start()
            if "Exchange" in line:
                found.append(line.strip())
    assert depth
    return found


@pytest.fixture
def shuffled_sides(spark, monkeypatch):
    """Nothing is broadcast, as with sides beyond every bound."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def bucketed_fact(spark, database, fact):
    return save_table(fact, f"{database}.fact", buckets=8, bucket_by=["patient_key"])


def small_sides(a):
    return a.terminology, a.profile


def test_history_of_bucketed_facts_needs_no_exchange(spark, database):
    a = Analogue(spark, FOLDER)
    index = analogue_index(a).select("ir_id", "patient_key", "surgery_start_date_key").checkpoint()
    plain = history_firsts(index, a.diagnoses, a.terminology, MATRIX_RULES, settled=True)
    fact = bucketed_fact(spark, database, a.diagnoses)
    found = history_firsts(index, fact, a.terminology, MATRIX_RULES, settled=True)
    assert rows(found) == rows(plain) != []
    plan = final_plan(found)
    # The last one brings candidates of one person together; the fact's rows are reduced by then.
    assert all("ir_id" in line for line in fact_exchanges(plan, "fact"))
    assert any("patient_key" in line for line in final_plan(plain).splitlines() if "Exchange hashpartitioning" in line)


def test_earliest_dates_of_bucketed_facts_need_no_exchange(spark, database):
    a = Analogue(spark, FOLDER)
    terms = a.terminology.select("diagnosis_key", (F.col("diagnosis_code") < "Brand#2").alias("g_low"))
    fact = bucketed_fact(spark, database, a.diagnoses)
    found = earliest_by_patient(fact, terms)
    assert rows(found) == rows(earliest_by_patient(a.diagnoses, terms)) != []
    assert fact_exchanges(final_plan(found), "fact") == []


def test_outcomes_of_bucketed_facts_shuffle_the_index_only(spark, database, monkeypatch):
    a = Analogue(spark, FOLDER)
    index = analogue_index(a).select("ir_id", "patient_key").checkpoint()
    keys = value_set(a.terminology, OUTCOME).checkpoint()
    fact = bucketed_fact(spark, database, a.diagnoses)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = events_for(index, fact, keys, settled=True, small_index=False)
        assert rows(found) == rows(events_for(index, a.diagnoses, keys, settled=True)) != []
        plan = final_plan(found)
        exchanges = fact_exchanges(plan, "fact")
        assert all("ir_id" in line for line in exchanges)  # of the distinct, behind the join
        assert "SortMergeJoin [patient_key" in plan or "ShuffledHashJoin [patient_key" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orders_of_bucketed_facts_need_no_exchange_before_distinct(spark, database):
    a = Analogue(spark, FOLDER)
    cohort = a.patients.select("ir_id", "patient_key")
    views = (a.medications, a.medication_orders, a.order_profile, cohort, a.patients, PATTERN_CLASSES, ("F", "O"))
    expected = rows(medication_exposure(*views))
    fact = bucketed_fact(spark, database, a.medication_orders)
    found = medication_exposure(views[0], fact, *views[2:])
    assert rows(found) == expected != []
    assert fact_exchanges(final_plan(found), "fact") == []


def test_names_of_a_warehouse(spark, database):
    save_table(Analogue(spark, FOLDER).patients, f"{database}.vw_patient")
    for name, where in ((f"{database}.vw_patient", None), (f"spark_catalog.{database}.vw_patient", None), ("vw_patient", database)):
        warehouse = Warehouse.from_catalog(spark, {"patient": name}, database=where)
        assert warehouse.view("patient").count() == Analogue(spark, FOLDER).patients.count()


# -- key filters -------------------------------------------------------------------


def test_filter_drops_rows_before_they_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1 << 16)
    fact = spark.range(200_000).select((F.col("id") * 7 % 100_003).alias("k"), F.col("id").alias("row"))
    keys = spark.range(0, 100_003, 50).select(F.col("id").alias("k"))
    found = keep_keys(fact, keys, small=False)
    assert rows(found) == rows(fact.join(keys, "k", "left_semi"))
    plan = final_plan(found)
    assert re.search(r"BroadcastHashJoin \[pmod\(xxhash64", plan)
    checkpointed = keys.checkpoint()
    words = key_filter(checkpointed)
    passed = may_have_key(fact, words, ["k"]).count()
    assert found.count() <= passed < 0.07 * 200_000
    assert words.size <= (1 << 16) // sizing.WORD_BYTES and words.words.count() <= words.size


def test_no_key_is_lost_and_filters_merge(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    halves = [key_filter(keys.where(c).checkpoint(), size=1024) for c in ("a < '4'", "a >= '4'")]
    whole = halves[0].merged(halves[1])
    assert may_have_key(keys, whole, ["a", "b"]).count() == 5000
    assert rows(whole.words) == rows(key_filter(keys.checkpoint(), size=1024).words)
    with pytest.raises(ValueError, match="one size"):
        halves[0].merged(key_filter(keys.checkpoint(), size=512))


def test_too_many_keys_make_no_filter(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 480)
    assert key_filter(spark.range(1000).checkpoint()) is None
    fact = spark.range(50).withColumnRenamed("id", "k")
    keys = spark.createDataFrame([(k,) for k in (*range(3, 300), None, None)], "k long")
    assert keep_keys(fact, keys, small=False).count() == 47
    assert keep_keys(fact, keys.limit(0), small=False).count() == 0
