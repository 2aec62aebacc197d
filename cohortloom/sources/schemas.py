"""Schemas of the warehouse views, and the check made when one is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns the operators read, by view. A view may have more.
_LONG, _TEXT, _DATE, _MOMENT = "long", "string", "date", "timestamp_ntz"
VIEWS: dict[str, dict[str, str]] = {
    "coded_procedure": {
        "coded_procedure_key": _LONG,
        "patient_key": _LONG,
        "procedure_key": _LONG,
        "visit_key": _LONG,
        "encounter_inpatient_key": _LONG,
        "coded_procedure_date_key": _DATE,
    },
    "procedure": {
        "procedure_key": _LONG,
        "procedure_name": _TEXT,
        "code_type": _TEXT,
        "procedure_code": _TEXT,
    },
    "patient": {
        "patient_key": _LONG,
        "ir_id": _LONG,
        "birth_date": _DATE,
        "race_1": _TEXT,
        "gender": _TEXT,
        "death_date": _DATE,
    },
    "patient_current": {"ir_id": _LONG, "patient_key": _LONG},
    "encounter_inpatient": {
        "encounter_inpatient_key": _LONG,
        "discharge_datetime": _MOMENT,
    },
    "diagnosis_event": {
        "diagnosis_event_key": _LONG,
        "patient_key": _LONG,
        "diagnosis_key": _LONG,
        "diagnosis_event_profile_key": _LONG,
        "start_datetime": _MOMENT,
        "start_date_key": _DATE,
    },
    "diagnosis_terminology": {
        "diagnosis_key": _LONG,
        "diagnosis_code_set": _TEXT,
        "diagnosis_code": _TEXT,
        "diagnosis_code_base": _TEXT,
        "diagnosis_name": _TEXT,
    },
    "diagnosis_event_profile": {"diagnosis_event_profile_key": _LONG, "load_type": _TEXT},
    "medication": {"medication_key": _LONG, "medication_name": _TEXT, "generic_name": _TEXT},
    "medication_order": {
        "medication_key": _LONG,
        "patient_key": _LONG,
        "medication_order_profile_key": _LONG,
        "order_placed_datetime": _MOMENT,
        "order_start_datetime": _MOMENT,
        "order_end_datetime": _MOMENT,
    },
    "medication_order_profile": {"medication_order_profile_key": _LONG, "order_status": _TEXT},
}

# Keys with a number that means there is nothing.
NUMBERED = ("encounter_inpatient_key", "medication_key")

# Accepted besides the type itself. Other keys may be of any integral or text type.
_EQUIVALENT = {
    _LONG: (T.IntegralType, T.StringType),
    _TEXT: (T.StringType,),
    _DATE: (T.DateType,),
    _MOMENT: (T.TimestampNTZType, T.TimestampType, T.DateType),
}


def view_schema(view: str) -> T.StructType:
    """The schema of one view, for readers that need it up front and for tests."""
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in VIEWS[view].items()))


def check_view(df: DataFrame, view: str) -> DataFrame:
    """``df`` unchanged, or ValueError naming every missing or mistyped column.

    A date key stored as a yyyymmdd integer is refused, as a cast would read it
    as seconds; convert it with ``int_date_key``. So are keys stored as text where
    operators compare them with a number.
    """
    found = {f.name: f.dataType for f in df.schema}
    problems = [
        f"{column} is {found[column].simpleString()}, not {kind}" if column in found else f"no {column}"
        for column, kind in VIEWS[view].items()
        if column not in found
        or not isinstance(found[column], T.IntegralType if column in NUMBERED else _EQUIVALENT[kind])
    ]
    if problems:
        raise ValueError(f"{view}: " + "; ".join(problems))
    return df


def trim_codes(df: DataFrame, *columns: str) -> DataFrame:
    """Text codes without trailing blanks, for sources that pad them."""
    return df.withColumns({c: F.rtrim(F.col(c)) for c in columns})
