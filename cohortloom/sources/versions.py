"""Intermediates that outlive a session: versions in folders, of which readers see committed ones only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_COMMITS = "number long, version string, stage_key string"


def _commits(spark: SparkSession, folder: str) -> list[Row]:
    """The commits of a folder, oldest first; one small row per version ever written."""
    try:
        return spark.read.schema(_COMMITS).json(f"{folder}/_commits").orderBy("number", "version").collect()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def write_version(df: DataFrame, folder: str, stage_key: str = "") -> str:
    """Write ``df`` as a new version of ``folder`` and commit it; the version's name.

    The rows go to a folder of their own, under a name that no other writer has. Only when all
    are there is one commit row added. A writer that is killed leaves a folder without a commit,
    which no reader looks at and a rerun does not touch, and readers of an older version keep it.
    Of commits made at the same time the greater version name counts as the newer one.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{folder}/version={version}")
    number = max((c.number for c in _commits(spark, folder)), default=0) + 1
    commit = spark.createDataFrame([(number, version, stage_key)], _COMMITS)
    commit.coalesce(1).write.mode("append").json(f"{folder}/_commits")
    return version


def committed_version(spark: SparkSession, folder: str, stage_key: str | None = None) -> str | None:
    """The newest committed version, with that key if one is given; None if there is none."""
    found = [c.version for c in _commits(spark, folder) if stage_key in (None, c.stage_key)]
    return found[-1] if found else None


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The newest committed version of a folder, or a given one if it is committed."""
    known = [c.version for c in _commits(spark, folder)]
    if not known or version not in (None, *known):
        raise FileNotFoundError(f"{folder} has no committed version{'' if version is None else ' ' + version}")
    return spark.read.parquet(f"{folder}/version={version or known[-1]}")


def stage(spark: SparkSession, folder: str, stage_key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The committed result of a stage, which is only built if there is none for its key.

    ``stage_key`` should name what the result depends on: inputs, their versions, parameters. A job
    that is run again after it was killed so goes on behind the last stage that it committed.
    """
    done = committed_version(spark, folder, stage_key)
    return read_version(spark, folder, done or write_version(build(), folder, stage_key))


def version_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All committed versions' rows, with the columns version and version_number."""
    commits = _commits(spark, folder)
    if not commits:
        raise FileNotFoundError(f"{folder} has no committed version")
    listed = spark.createDataFrame([(c.version, c.number) for c in commits], "version string, version_number long")
    paths = [f"{folder}/version={c.version}" for c in commits]
    rows = spark.read.option("basePath", folder).parquet(*paths)
    return rows.withColumn("version", F.col("version").cast("string")).join(F.broadcast(listed), "version")
