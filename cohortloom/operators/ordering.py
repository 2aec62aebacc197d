"""Whether a result is in order, told from its partitions without collecting rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_violations(
    df: DataFrame, order_by: Sequence[str], part: Column | None = None, place: Column | None = None
) -> DataFrame:
    """One row (n_rows, n_parts, violations): how often a row comes after one it should precede.

    Order is ascending, NULL first. Within a part neighbours are compared; between parts, in
    the order of ``part``, the last key of one with the first key of the next that has rows. Only the
    key columns are shuffled, each part by itself, and what is compared across parts is one
    row per part. By default parts and places are those that ``df`` has as it is computed, as for
    a result of ``orderBy``; for files see :func:`file_violations`.
    """
    key = F.struct(*order_by).alias("key")
    part = F.spark_partition_id() if part is None else part
    place = F.monotonically_increasing_id() if place is None else place
    keys = df.select(key, part.alias("part"), place.alias("place"))
    inside = Window.partitionBy("part").orderBy("place")
    previous = keys.withColumn("previous", F.lag("key").over(inside))
    parts = previous.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("previous") > F.col("key")).alias("wrong"),
        F.min_by("key", "place").alias("first"),
        F.max_by("key", "place").alias("last"),
    )
    # One row per part from here on.
    turn = Window.orderBy("part")
    met = parts.withColumn("before", F.lag("last").over(turn))
    across = F.count_if(F.col("before") > F.col("first"))
    return met.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_parts"),
        (F.coalesce(F.sum("wrong"), F.lit(0)) + across).alias("violations"),
    )


def file_violations(written: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """:func:`order_violations` of files in the order of their names, as a writer numbers them.

    ``written`` is a DataFrame that reads files of which each is one task's, such as those of
    ``read_csv``, or Parquet files.
    """
    return order_violations(written, order_by, part=F.input_file_name())
