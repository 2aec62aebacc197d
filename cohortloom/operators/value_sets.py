"""Lookups in dimensions: keys of a value set, of load types, and data profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.rules import Rule


def value_set(terminology: DataFrame, rule: Rule, case_sensitive: bool = False) -> DataFrame:
    """Distinct diagnosis keys that ``rule`` covers. Dates play no part here."""
    return (
        terminology.where(rule.condition(case_sensitive=case_sensitive))
        .select("diagnosis_key")
        .distinct()
    )


def load_keys(profile: DataFrame, load_types: Sequence[str]) -> DataFrame:
    """Profile keys of diagnosis events with one of the load types."""
    accepted = profile.where(F.col("load_type").isin(*load_types))
    return accepted.select("diagnosis_event_profile_key")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct values (or combinations) of some columns, as a data profile."""
    return df.select(*columns).distinct()


def point_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with one value in a column; the value is cast to the column's type."""
    return df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))
