"""What several tests of the training-data operators use."""

import re

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("Size", T.IntegerType()),
        T.StructField("lines", T.StringType()),
        T.StructField("shard", T.StringType()),
    ]
)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark, rows, slices=3):
    """Documents from (doc_id, text, source), with extra columns whose names clash with results."""
    full = [(*(tuple(r) + (None,) * 3)[:3], "x", 7, "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(slices)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)
