"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Words are separated by ASCII white space only, which is what bytes.split() does too.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\v\f\r"


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that no column has, whatever its case."""
    used = {name.lower() for name in taken}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name


def word_count(text: Column) -> Column:
    """Words of a text as bigint, 0 for null; evaluated in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def modest_batches(spark: SparkSession) -> None:
    """Whole texts go to Python 1,000 rows at a time, unless the session says something itself.

    Spark's default of 10,000 rows is meant for narrow rows; of texts it makes batches that are
    held several times over, by the JVM's buffers and by each Python worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def word_chunks(
    texts: list[str | None], limit: int, lower: bool = False
) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Consecutive texts as words, with the position of the first; up to ``limit`` words
    together, or one longer text. ``lower`` makes A-Z small."""
    first, some, size = 0, [], 0
    for i, text in enumerate(texts):
        body = text.encode() if text else b""
        words = (body.lower() if lower else body).split()
        if some and size + len(words) > limit:
            yield first, some
            first, some, size = i, [], 0
        some.append(words)
        size += len(words)
    if some:
        yield first, some
