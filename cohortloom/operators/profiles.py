"""Profiles of many columns from one pass, kept as states that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_LG = 14  # HyperLogLog registers as a power of two: a standard error of 1.04 / 2**7, 0.8 %
QUANTILE_K = 1024  # size of a KLL sketch: ranks are right within 0.3 %, and exact up to so many values

STATE = (
    "column_name string, n_rows long, n_nulls long, least string, greatest string, "
    "distinct_sketch binary, quantile_sketch binary"
)


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of :data:`STATE` per column, from one pass over ``df``.

    Every task reduces its rows to a state of a few kilobytes a column, so what is shuffled does not
    grow with the rows or with the number of values. Numbers also get a quantile sketch, in doubles. An
    empty table gives counts of 0 and no least or greatest value.
    """
    names = list(df.columns if columns is None else columns)
    states = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(name).isNull()).alias("n_nulls"),
            F.min(name).cast("string").alias("least"),
            F.max(name).cast("string").alias("greatest"),
            F.hll_sketch_agg(F.col(name).cast("string"), DISTINCT_LG).alias("distinct_sketch"),
            _quantiles(F.col(name), df.schema[name].dataType).alias("quantile_sketch"),
        )
        for name in names
    ]
    return df.agg(F.array(*states).alias("states")).select(F.explode("states").alias("state")).select("state.*")


def _quantiles(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.NumericType):
        return F.lit(None).cast("binary")
    return F.kll_sketch_agg_double(value.cast("double"), QUANTILE_K)


def merge_profiles(*states: DataFrame, numbers: Sequence[str] = ()) -> DataFrame:
    """The state of all rows that the given states are of.

    Least and greatest values are kept as text; those of the columns in ``numbers`` are
    compared as numbers.
    """
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    by_number = F.col("column_name").isin(*numbers)
    order = [F.when(by_number, F.col(c).cast("double")) for c in ("least", "greatest")]
    kept = every.withColumns(
        {
            "low": F.when(F.col("least").isNotNull(), F.struct(order[0].alias("n"), F.col("least").alias("t"))),
            "high": F.when(F.col("greatest").isNotNull(), F.struct(order[1].alias("n"), F.col("greatest").alias("t"))),
        }
    )
    return kept.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("low")["t"].alias("least"),
        F.max("high")["t"].alias("greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", QUANTILE_K).alias("quantile_sketch"),
    )


def profile(state: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """(column_name, n_rows, n_nulls, n_distinct, least, greatest, quantiles) of a state.

    ``quantiles`` is an array of doubles, NULL where there are no numbers: of each share the least
    value that so many of the numbers do not exceed.
    """
    has_numbers = F.col("quantile_sketch").isNotNull() & (F.kll_sketch_get_n_double("quantile_sketch") > 0)
    found = F.array(*(F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))) for q in quantiles))
    return state.select(
        "column_name",
        "n_rows",
        "n_nulls",
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).alias("n_distinct"),
        "least",
        "greatest",
        F.when(has_numbers, found).alias("quantiles"),
    )
