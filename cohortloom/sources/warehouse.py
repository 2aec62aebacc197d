"""Reading warehouse views from Parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.schemas import VIEWS, check_view


def load(
    spark: SparkSession, folder: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The Parquet table ``name`` in ``folder``; filters and columns are pushed down.

    With a ``schema`` no file footer is read to find one.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def load_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A catalog table by one-, two- or three-part name.

    A one-part name is looked up in ``database`` if that is given. The session's
    current database stays as it is.
    """
    return spark.table(name if database is None or "." in name else f"{database}.{name}")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Make sure a database is there; its tables are kept under ``location``."""
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    return name


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
) -> DataFrame:
    """Save ``df`` as the Parquet table ``name`` (two or three parts), replacing it, and read it.

    ``partition_by`` columns become folders, so that a filter on them leaves files out.
    ``buckets`` deals the rows out by ``bucket_by`` once; joins and aggregations on these columns
    then need no exchange of this table. Take as many buckets as ``spark.sql.shuffle.partitions``
    or more: with fewer, Spark shuffles both sides for parallelism. A bucket is read by one task,
    so a hot key makes a large bucket; facts with very hot keys are better left unbucketed,
    where AQE can split them.
    """
    if bool(buckets) != bool(bucket_by):
        raise ValueError("buckets and bucket_by go together")
    if buckets:  # one file per bucket and partition, instead of one per task
        df = df.repartition(buckets, *bucket_by)
    elif partition_by:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(PARTITION_FILES)))
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


PARTITION_FILES = 16  # files of a partition folder at most, so that a large one has many writers


def year_column(day: str) -> str:
    """Name of the partition column that :func:`with_year` adds for a date column."""
    return f"{day}_year"


def with_year(df: DataFrame, day: str) -> DataFrame:
    """``df`` with the year of a date column, to partition by."""
    return df.withColumn(year_column(day), F.year(day))


def between_days(df: DataFrame, day: str, first: date, last: date) -> DataFrame:
    """Rows with a date from ``first`` to ``last``.

    On a table that is partitioned by the date's year the other years are not read.
    """
    kept = df.where(F.col(day).between(F.lit(first), F.lit(last)))
    if year_column(day) in df.columns:
        kept = kept.where(F.col(year_column(day)).between(first.year, last.year))
    return kept


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate for SQL access; a rerun replaces it."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop a named intermediate if there is one; tells whether there was."""
    return spark.catalog.dropTempView(name)


@dataclass(frozen=True)
class Warehouse:
    """The eleven views, each read on first use and checked against its schema.

    ``reader`` maps a view name to a DataFrame. ``adapters`` rename or convert
    the columns of a source that differs, before the check.
    """

    reader: Callable[[str], DataFrame]
    adapters: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, **kwargs) -> Warehouse:
        return cls(lambda view: load(spark, folder, view), **kwargs)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        names: Mapping[str, str],
        database: str | None = None,
        **kwargs,
    ) -> Warehouse:
        """``names`` maps view names to table names, e.g. ``{"patient": "dw.dim.patient"}``.

        One-part names are looked up in ``database`` if that is given.
        """
        return cls(lambda view: load_table(spark, names[view], database), **kwargs)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame], **kwargs) -> Warehouse:
        return cls(lambda view: frames[view], **kwargs)

    def view(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise KeyError(f"unknown view: {name}")
        adapt = self.adapters.get(name, lambda df: df)
        return check_view(adapt(self.reader(name)), name)
