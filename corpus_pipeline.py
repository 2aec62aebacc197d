"""The corpus pipeline: documents through five operators, each stage written and read again.

Every stage works on all rows that its predecessor kept; all but the last return the columns of
``documents``. A text that a stage shortens has its ``n_chars`` set anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import line_dedup, mixing, packing, quality_rules, simhash
from cohortloom.operators.materialize import ensure_checkpoint_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that more than a tenth of a source's distinct texts have go; documents stay."""
    lines = line_dedup.text_lines(F.col("text"))
    kept = line_dedup.drop_boilerplate(docs, F.col("source"), lines, copies_count=False)
    text = F.when(F.col("text").isNotNull(), F.array_join("lines", "\n"))
    return _with_text(kept, text, text != F.col("text")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked at 4 or fewer differing bits the document of smallest id stays.

    The operator's own shingles of four words and its bit distance decide, without another check.
    """
    return simhash.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or cut to their targets; a repeated document is several rows."""
    mixed = mixing.mix(docs)
    copied = mixing.copies(mixed.withColumn("_text", F.col("text")), [*docs.columns, "_text"])
    changed = F.col("text") != F.col("_text")
    return _with_text(copied, F.col("text"), changed).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: where each piece of each document goes."""
    return packing.pack(docs)


def _with_text(docs: DataFrame, text, changed) -> DataFrame:
    n_chars = F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return docs.withColumns({"text": text, "n_chars": n_chars})


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_boilerplate),
    ("simhash_near_dedup", without_near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]
#: No SQL: rules are learned, fingerprints need XXH64 and packing a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate results go to the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
