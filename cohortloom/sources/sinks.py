"""Result files: CSV with a manifest, and the typed reader that checks it."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What both sides agree on. Quotes inside a field are doubled, as other readers expect.
_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Stands for the empty field while it is parsed: NULL, as an empty text is a quoted one. It begins
# with a noncharacter, so no text that is meant for exchange is equal to it.
_NULL = "\ufdd0NULL"
_MANIFEST = "_manifest"  # readers of the folder skip names that begin with an underscore
_TOTALS = "rows long, checksum string, schema string"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", manifest: bool = False) -> None:
    """CSV with a header. Every task writes its own part file under ``path``.

    NULL is an empty field, an empty text is a quoted one. Blanks around a text stay.

    With a ``manifest``, the names and sizes of the parts, the number of rows and a checksum
    of all values that does not depend on their order are kept beside them, for
    :func:`read_csv`. Rows are counted while they are written, not in a second pass.
    """
    if not manifest:
        df.write.mode(mode).options(**_FORMAT).csv(path)
        return
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError(f"a manifest tells all parts of a folder, which mode {mode} may not write")
    totals = Observation()
    observed = df.observe(totals, *_totals(df.columns))
    observed.write.mode(mode).options(**_FORMAT).csv(path)
    found = totals.get
    spark = df.sparkSession
    _parts(spark, path).write.parquet(f"{path}/{_MANIFEST}/parts")
    # The totals come last: with them the result is whole.
    row = (found["rows"], str(found["checksum"]), df.schema.json())
    spark.createDataFrame([row], _TOTALS).coalesce(1).write.json(f"{path}/{_MANIFEST}/totals")


def _totals(columns: list[str]) -> list[Column]:
    """Row count and a sum of row hashes, wide enough never to overflow."""
    row = F.xxhash64(*columns).cast("decimal(20,0)") if columns else F.lit(0).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("checksum")]


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Names and sizes of the part files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


class DamagedResult(ValueError):
    """A result folder is not what its manifest says."""


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, verify: bool = False
) -> DataFrame:
    """A folder that :func:`write_csv` wrote, with its types; NULL and empty text are told apart.

    Fields may hold line breaks, so a part file is read by one task; write more and smaller
    parts for more tasks. A field that its type cannot hold is an error, as is a header that
    does not name the schema's columns.

    Without a ``schema`` the manifest's is used. If there is a manifest, parts that are missing,
    added or of another size raise :class:`DamagedResult`; ``verify`` also reads all rows and
    compares their number and checksum.
    """
    totals = _manifest(spark, path)
    if schema is None:
        if totals is None:
            raise ValueError(f"{path} has no manifest, so its schema must be given")
        schema = T.StructType.fromJson(json.loads(totals.schema))
    if totals is not None:
        _check_parts(spark, path)
    # Text columns are parsed as they are; other types never hold an empty text.
    rows = (
        spark.read.options(**_FORMAT)
        .options(multiLine=True, nullValue=_NULL, emptyValue="", enforceSchema=False, mode="FAILFAST")
        .schema(schema)
        .csv(path, pathGlobFilter="*.csv*")
    )
    if verify and totals is not None:
        found = rows.agg(*_totals(rows.columns)).first()
        if (found.rows, str(found.checksum)) != (totals.rows, totals.checksum):
            raise DamagedResult(f"{path}: rows differ from the manifest's {totals.rows}")
    return rows


def _manifest(spark: SparkSession, path: str) -> Row | None:
    """The one row of totals, or None where there is no manifest."""
    try:
        return spark.read.schema(_TOTALS).json(f"{path}/{_MANIFEST}/totals").first()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _check_parts(spark: SparkSession, path: str) -> None:
    listed = spark.read.schema("name string, length long").parquet(f"{path}/{_MANIFEST}/parts")
    both = _parts(spark, path).alias("f").join(listed.alias("m"), "name", "full")
    wrong = both.where(~F.col("f.length").eqNullSafe(F.col("m.length"))).first()
    if wrong is not None:
        raise DamagedResult(f"{path}: part {wrong.name} is not as the manifest says")
