"""Reliable materialization of a result that several consumers read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of numbers that one task writes by itself, at least, where their count is known.
ROWS_A_FILE = 16_384
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder; a cluster session must name it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="cohortloom-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def settle(df: DataFrame, free_shuffles: bool = False, rows: int | None = None) -> DataFrame:
    """``df`` written once to the checkpoint folder and read from there.

    Its lineage is cut, so consumers neither recompute it nor depend on the
    executors that produced it, and measuring its size is cheap. ``free_shuffles``
    has Spark remove the shuffle files that writing it took at once, not when the
    driver next happens to collect its garbage. ``rows`` is about how many narrow rows there
    are: few rows are then written as few files, however many partitions shuffles have. Each
    file costs the executor two processes where permissions are set by a command.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    ensure_checkpoint_dir(spark)
    if not free_shuffles:
        return df.checkpoint(eager=True)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        # A new DataFrame, since Spark reads the setting when one is made.
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
