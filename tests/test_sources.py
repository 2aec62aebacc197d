"""Loading, schema checks, named intermediates and the CSV sink."""

import csv
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from clinic import frames, patient, rows

from cohortloom.functions.expressions import int_date_key
from cohortloom.operators.medications import cohort_members
from cohortloom.operators.value_sets import distinct_values, point_lookup
from cohortloom.sources import (
    VIEWS,
    DamagedResult,
    Warehouse,
    check_view,
    drop_view,
    load,
    load_table,
    read_csv,
    replace_view,
    trim_codes,
    view_schema,
    write_csv,
)


def test_views_and_schemas(spark):
    assert len(VIEWS) == 11
    assert view_schema("patient").fieldNames()[:2] == ["patient_key", "ir_id"]


def test_check_names_every_problem(spark):
    frame = spark.createDataFrame([(20150101,)], "start_date_key int")
    with pytest.raises(ValueError, match="no patient_key.*start_date_key is int, not date"):
        check_view(frame, "diagnosis_event")
    with pytest.raises(KeyError):
        Warehouse.from_frames({}).view("elsewhere")


def test_parquet_warehouse_with_adapter(spark, tmp_path):
    folder = str(tmp_path)
    frame = spark.createDataFrame(
        [(1, 2, 3, 4, -2, 20150131, "x")],
        "coded_procedure_key long, patient_key long, procedure_key long, visit_key long, "
        "encounter_inpatient_key long, coded_procedure_date_key int, extra string",
    )
    frame.write.parquet(f"{folder}/coded_procedure.parquet")
    with pytest.raises(ValueError):
        Warehouse.from_parquet(spark, folder).view("coded_procedure")
    adapters = {
        "coded_procedure": lambda df: df.withColumn(
            "coded_procedure_date_key", int_date_key(df.coded_procedure_date_key)
        )
    }
    view = Warehouse.from_parquet(spark, folder, adapters=adapters).view("coded_procedure")
    assert str(view.first().coded_procedure_date_key) == "2015-01-31"
    narrow = load(spark, folder, "coded_procedure", "patient_key long")
    assert narrow.columns == ["patient_key"]


def test_catalog_tables_by_two_and_three_part_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dim")
    frames(spark, patient=[patient(1, 10)])["patient"].write.mode("overwrite").saveAsTable("dim.vw_patient")
    try:
        names = {"patient": "spark_catalog.dim.vw_patient"}
        assert Warehouse.from_catalog(spark, names).view("patient").count() == 1
        assert load_table(spark, "dim.vw_patient").count() == 1
        assert load_table(spark, "vw_patient", database="dim").count() == 1
        named = Warehouse.from_catalog(spark, {"patient": "vw_patient"}, database="dim")
        assert named.view("patient").count() == 1
        assert spark.catalog.currentDatabase() == "default"
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE dim CASCADE")


def test_text_is_refused_for_keys_that_are_compared_with_numbers(spark):
    frame = spark.createDataFrame([("1", "a", "b")], "medication_key string, medication_name string, generic_name string")
    with pytest.raises(ValueError, match="medication_key is string"):
        check_view(frame, "medication")


def test_named_intermediates_can_be_rerun(spark):
    replace_view(spark.range(1), "stage")
    assert replace_view(spark.range(3), "stage").count() == spark.table("stage").count() == 3
    assert spark.sql("WITH w AS (SELECT * FROM stage) SELECT count(*) FROM w").first()[0] == 3
    assert drop_view(spark, "stage") is True
    assert drop_view(spark, "stage") is False


TEXTS = (
    "", None, " a ", 'q"x",y\nz', "a\r\nb\rc", "\\", '"', "NULL", "\0", "\t", "#x", "'", '""', ",", "\n", "\u00a0", "漢字", "null",
)
NUMBERS = (1.5, None, float("nan"), float("inf"), -0.0, 1e-300, 0.1)
TYPED = "n long, t string, d double, at timestamp_ntz, b boolean, day date, exact decimal(20,2), u string"


def typed_rows():
    for n, text in enumerate(TEXTS):
        at = datetime(2015, 1, 1, 8, 0, 0, 123456) if n % 2 else None
        day = date(1950 + n, 1, 1) if n % 3 else None
        yield n, text, NUMBERS[n % 7], at, (True, False, None)[n % 3], day, Decimal(f"{n}.25"), TEXTS[-n]


@pytest.mark.parametrize("manifest", [True, False])
def test_csv_round_trip(spark, tmp_path, manifest):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame(list(typed_rows()), TYPED).repartition(3)
    write_csv(frame.limit(0), path, manifest=manifest)
    assert read_csv(spark, path, frame.schema, verify=True).collect() == []
    write_csv(frame, path, manifest=manifest)
    found = read_csv(spark, path, None if manifest else TYPED, verify=True)
    assert found.schema == frame.schema
    assert [repr(r) for r in found.orderBy("n").collect()] == [repr(r) for r in frame.orderBy("n").collect()]
    read = []
    for part in Path(path).glob("*.csv"):
        with part.open(newline="") as file:
            read += list(csv.reader(file))[1:]
    assert {int(r[0]): r[1] for r in read} == {n: t or "" for n, t in enumerate(TEXTS)}


def test_csv_of_one_column(spark, tmp_path):
    frame = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    write_csv(frame, str(tmp_path / "out"), manifest=True)
    assert rows(read_csv(spark, str(tmp_path / "out"), verify=True)) == rows(frame)


def test_csv_without_manifest_needs_a_schema(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(3), path)
    with pytest.raises(ValueError, match="no manifest"):
        read_csv(spark, path)
    with pytest.raises(ValueError, match="manifest tells all parts"):
        write_csv(spark.range(3), path, mode="append", manifest=True)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, "other long").collect()
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        write_csv(spark.createDataFrame([("x",)], "id string"), path)
        read_csv(spark, path, "id long").collect()


def test_damaged_results_are_refused(spark, tmp_path):
    path = tmp_path / "out"
    write_csv(spark.range(100).repartition(4), str(path), manifest=True)
    assert read_csv(spark, str(path), verify=True).count() == 100
    part = sorted(path.glob("*.csv"))[0]
    whole = part.read_text()
    part.write_text(whole + "7\n")
    (path / f".{part.name}.crc").unlink()
    with pytest.raises(DamagedResult, match=part.name):
        read_csv(spark, str(path))
    assert len(whole) > 5
    digits = str.maketrans("12", "21")
    part.write_text(whole.translate(digits) if whole.translate(digits) != whole else whole.replace("3", "4"))
    read_csv(spark, str(path))  # sizes agree
    with pytest.raises(DamagedResult, match="rows differ"):
        read_csv(spark, str(path), verify=True)
    part.unlink()
    with pytest.raises(DamagedResult, match=part.name):
        read_csv(spark, str(path))


def test_trailing_blanks(spark):
    frame = spark.createDataFrame([("I48  ", "x ")], "code string, name string")
    assert trim_codes(frame, "code").first() == ("I48", "x ")


def test_cohort_profile_and_lookup(spark):
    current = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (2, 20), (None, 30)], "ir_id long, patient_key long"
    )
    ids = spark.createDataFrame([(1,), (1,), (9,), (None,)], "ir_id long")
    assert rows(cohort_members(current, ids)) == [(1, 10), (1, 11)]
    assert rows(distinct_values(current, "ir_id")) == [(1,), (2,), (None,)]
    assert rows(point_lookup(current, "ir_id", "2")) == [(2, 20)]
    assert rows(point_lookup(current, "ir_id", 1)) == [(1, 10), (1, 10), (1, 11)]
