"""A hand-made warehouse: rows given as tuples in the column order of VIEWS."""

from datetime import date, datetime

from cohortloom.sources import Warehouse, view_schema

BEFORE, INDEX_DAY, AFTER = date(2010, 1, 1), date(2015, 6, 1), date(2016, 1, 1)


def frames(spark, **rows):
    return {view: spark.createDataFrame(list(data), view_schema(view)) for view, data in rows.items()}


def clinic(spark, **rows):
    """Views not given are empty, but for one bypass code and the load types."""
    views = {
        "coded_procedure": [],
        "procedure": [(1, "Bypass", "CPT", "33510")],
        "patient": [],
        "patient_current": [],
        "encounter_inpatient": [],
        "diagnosis_event": [],
        "diagnosis_terminology": [],
        "diagnosis_event_profile": [(1, "Problem List"), (2, "Medical History")],
        "medication": [],
        "medication_order": [],
        "medication_order_profile": [(1, "Sent"), (2, "Cancelled")],
    }
    views.update(rows)
    return Warehouse.from_frames(frames(spark, **views))


def patient(key, person, birth=date(1950, 1, 1)):
    return (key, person, birth, "race", "gender", None)


def surgery(case, patient_key, day=INDEX_DAY, encounter=1, procedure=1):
    return (case, patient_key, procedure, 100 + case, encounter, day)


def diagnosis(event, patient_key, term, day, profile=1):
    moment = datetime(day.year, day.month, day.day, 8) if day else None
    return (event, patient_key, term, profile, moment, day)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
