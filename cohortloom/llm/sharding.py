"""Sharding by extendible hashing, with native column expressions only.

A row's hash is read bit by bit. The directory starts as one bucket; a bucket above the byte
limit splits on the next bit, the others stay as they are, so a shard is a hash prefix that
fits while its parent does not. All splits down to a depth come from one aggregation: bytes are
summed per hash cell of that depth, cells are rolled up to every shorter prefix, and each cell
takes its shortest prefix that fits. Rows of cells that still are too large go on with further
bits, and only they are read again.

Rows with equal hashes (one key with very many rows) cannot be told apart by bits. They are
numbered by the library's distributed row number and dealt out in runs that fit.

Defined cases: null ids are a key of their own; a null text has 0 bytes; a text that is itself above
the limit is a shard by itself; repeated rows are kept; an empty table gives an empty result.
Input columns named like the new ones are replaced; helper columns take names that no input column has.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import fresh
from cohortloom.operators.materialize import settle
from cohortloom.operators.numbering import global_row_number

HASH_BITS = 60
FIRST_BITS = 12  # of the cells that are summed first
SHARD_BYTES = 1 << 20
NEW = ("n_bytes", "shard", "depth", "shard_bytes")


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5; null and the empty text differ."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _prefix(h: Column | str, depth: Column | int) -> Column:
    """The first ``depth`` bits, as a number."""
    return F.expr(f"shiftright({h}, {HASH_BITS} - ({depth}))")


def _cells(rows: DataFrame, depth: int) -> DataFrame:
    """(cell, bytes) of every hash cell of ``depth`` bits, from rows (hash, bytes)."""
    return settle(rows.groupBy(_prefix("hash", depth).alias("cell")).agg(F.sum("bytes").alias("bytes")))


def _directory(cells: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """(cell, depth, shard_bytes): the bucket of each hash cell of ``depth`` bits, with a null
    depth for cells that are too large. Prefixes of up to ``above`` bits are known not to fit."""
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(above), F.lit(depth))))
    parent = F.expr(f"shiftright(cell, {depth} - level)")
    levels = levels.withColumn("parent", parent)
    fits = (
        levels.groupBy("level", "parent").agg(F.sum("bytes").alias("shard_bytes"))
        .withColumn("fits", F.col("shard_bytes") <= limit)
    )
    # Only prefixes that fit and whose parent does not are buckets.
    known = fits.select((F.col("level") + 1).alias("level"), F.col("parent").alias("above"), F.col("fits").alias("parent_fits"))
    leaves = (
        fits.filter("fits").withColumn("above", F.expr("shiftright(parent, 1)"))
        .join(known, ["level", "above"], "left")
        .filter(~F.coalesce("parent_fits", F.lit(False)))
        .select("level", "parent", "shard_bytes")
    )
    found = levels.join(leaves, ["level", "parent"]).select("cell", F.col("level").alias("depth"), "shard_bytes")
    return settle(cells.select("cell").join(found, "cell", "left"))


def shard(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES
) -> DataFrame:
    """``docs`` with n_bytes, shard (its hash prefix in binary), depth and shard_bytes."""
    others = [c for c in docs.columns if c.lower() not in NEW or c in (id_column,)]
    hashed, cell = (fresh([*docs.columns, *NEW], name) for name in ("hash", "cell"))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = docs.select(*(F.col(c) for c in others), size.alias("n_bytes"), hash_bits(F.col(id_column)).alias(hashed))

    def measured(some: DataFrame) -> DataFrame:
        return some.select(F.col(hashed).alias("hash"), F.col("n_bytes").alias("bytes"))

    # The first cells tell the total, and with it how many bits are needed; often they are enough.
    above, depth, left, parts = 0, FIRST_BITS, rows, []
    cells = _cells(measured(rows), depth)
    total = cells.agg(F.sum("bytes")).first()[0] or 0
    wanted = min(HASH_BITS, max(0, ceil(log2(max(1, total / limit)))) + 3)
    if wanted > depth:
        depth = wanted
        cells = _cells(measured(rows), depth)
    bits = F.lpad(F.bin(hashed), HASH_BITS, "0")
    while True:
        directory = _directory(cells, above, depth, limit)
        placed = left.withColumn(cell, _prefix(hashed, depth)).join(directory.withColumnRenamed("cell", cell), cell)
        shard_name = F.substring(bits, F.lit(1), F.col("depth"))
        parts.append(placed.filter("depth is not null").select(*others, "n_bytes", shard_name.alias("shard"), "depth", "shard_bytes"))
        if not directory.filter("depth is null").head(1):
            break
        # Written, so that deeper rounds do not read all rows again.
        left = settle(placed.filter("depth is null").select(*rows.columns))
        if depth == HASH_BITS:
            dealt = _deal_out(left, hashed, limit)
            parts.append(dealt.select(*others, "n_bytes", F.concat_ws("-", bits, "shard").alias("shard"), "depth", "shard_bytes"))
            break
        above, depth = depth + 1, min(HASH_BITS, depth + 8)
        cells = _cells(measured(left), depth)
    return reduce(DataFrame.unionByName, parts)


def _deal_out(rows: DataFrame, hashed: str, limit: int) -> DataFrame:
    """Rows whose whole hash is shared by more than a shard, in runs within the limit.

    The column shard is the run's number. Rows are dealt out by size and then by a hash of their
    contents, so runs do not depend on partitions.
    """
    taken = [*rows.columns, *NEW]
    contents, number, first, most = (fresh(taken, name) for name in ("contents", "number", "first", "most"))
    ordered = rows.withColumn(contents, F.xxhash64(*rows.columns))
    numbered = settle(global_row_number(ordered, [hashed, "n_bytes", contents], number).drop(contents))
    groups = settle(numbered.groupBy(hashed).agg(F.min(number).alias(first), F.max("n_bytes").alias(most)))
    per_run = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col(most), F.lit(1))))
    runs = settle(
        numbered.join(groups, hashed)
        .withColumn("shard", F.floor((F.col(number) - F.col(first)) / per_run).cast("string"))
        .drop(number, first, most)
    )
    sums = settle(runs.groupBy(hashed, "shard").agg(F.sum("n_bytes").alias("shard_bytes")))
    return runs.join(sums, [hashed, "shard"]).withColumn("depth", F.lit(HASH_BITS))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a shard is written by one task, and tasks get whole ranges of shards."""
    sharded.repartitionByRange("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)
