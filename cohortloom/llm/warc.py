"""Deterministic sharded WARC writer and reader.

Records are sorted by page id and cut into shards at key bounds taken from a bounded sample chosen by
hash, so equal input gives equal files whatever the partitioning. Every shard is a task's, which writes it record by
record, each record a gzip member without a time stamp, and begins a new file when the compressed
size passes the limit. Digests and headers are made anew from the payload.

Of records with equal payload, the one with the largest page id is the response and the others
revisit it. That decision needs ids and digests only; payloads are shuffled once, to their shard,
where a small decision row sorts in front of each record.

Every attempt writes under temporary names of its own. The manifest, a Parquet table that only
takes what successful tasks report, says which of them count; then tasks rename those to
their final names, and a marker with the number of files and records is written last. Renaming may be
repeated. A reader takes the manifest's files, so leftovers of lost attempts are never read.

Folders are reached through pyarrow's file systems (file, hdfs, s3, gs), on executors too.

Defined cases: a null payload is empty; null page ids sort last and are only
responses when no other id has the payload; repeated rows (equal id and payload) are records of
their own and all of the same type; payloads may be of any length that a row holds; an empty table gives a
manifest without files. Only the id, URL and payload columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import modest_batches
from cohortloom.operators.materialize import ensure_checkpoint_dir, settle

FILE_BYTES = 64 << 20  # compressed; a file ends with the record that passes it
SHARD_BYTES = 256 << 20  # payload bytes of a shard, about
LEAST_SHARDS = 32  # so that small tables are written by more than one task
MOST_SHARDS = 16_384  # beyond which shards, each of several files, become larger
SAMPLED_PER_SHARD = 64  # so at most a million ids reach the driver
TASK_BYTES = 64 << 20  # compressed bytes that a reading task takes, about
DATE = "1970-01-01T00:00:00Z"  # pages have no date of their own
MANIFEST = "shard long, number long, temporary string, name string, records long, bytes long, sha1 string"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI and the path on it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; of a revisit's payload only the digest and length are kept."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http.encode() + (b"" if revisit else payload)
    name = "null" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}:{digest}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Page-Id", name),
        ("X-Payload-Length", str(size)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[4:4] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{digest}')}>"),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member that holds no time or name."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Writes the records of one shard to files under temporary names."""

    def __init__(self, system: fs.FileSystem, folder: str, shard: int, limit: int):
        self.system, self.folder, self.shard, self.limit = system, folder, shard, limit
        self.attempt, self.number, self.done, self.out = uuid.uuid4().hex, 0, [], None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"temporary/{self.shard:08d}-{self.number:05d}-{self.attempt}.warc.gz"
            self.out = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha1()
        member = _member(data)
        self.out.write(member)
        self.sum.update(member)
        self.records += 1
        self.bytes += len(member)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            final = f"pages-{self.shard:08d}-{self.number:05d}.warc.gz"
            self.done.append((self.shard, self.number, self.name, final, self.records, self.bytes, self.sum.hexdigest()))
            self.number, self.out = self.number + 1, None


def _bounds(rows: DataFrame, shards: int) -> np.ndarray:
    """Upper ids of all shards but the last, from the ids of smallest hash."""
    sample = (
        rows.filter("id is not null").select("id").orderBy(F.xxhash64("id"), "id")
        .limit(SAMPLED_PER_SHARD * shards).toPandas()["id"].sort_values().to_numpy(np.int64)
    )
    return sample[[len(sample) * i // shards for i in range(1, shards)]] if len(sample) else sample


def write(
    pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
    least_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES,
    least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """Writes ``pages`` to ``folder`` and returns the committed manifest.

    Records below ``least_revisit_bytes`` of payload are responses whatever they equal.
    """
    spark = pages.sparkSession
    modest_batches(spark)
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("bigint")
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
        text.alias("payload"), F.sha1(text).alias("sha1"), size.alias("size"),
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = min(max(least_shards, -(-total // shard_bytes)), max(least_shards, MOST_SHARDS))
    bounds = spark.sparkContext.broadcast(_bounds(rows, shards))

    def of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(np.iinfo(np.int64).max).astype("int64")
        return pd.Series(np.searchsorted(bounds.value, known.to_numpy(), side="left"))

    shard = F.pandas_udf(of, "long")("id")
    keys = settle(rows.select("id", "sha1", "size"))
    last = settle(keys.filter(F.col("size") >= least_revisit_bytes).groupBy("sha1").agg(F.max("id").alias("refers")))
    decided = (
        keys.distinct().join(last, "sha1", "left")
        .select("id", "sha1", F.when(~F.col("id").eqNullSafe(F.col("refers")), F.col("refers")).alias("refers"))
    )
    decisions = decided.select(
        "id", "sha1", "refers", F.lit(0).alias("turn"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("payload"), F.lit(None).cast("long").alias("size"),
    )
    records = rows.select("id", "sha1", F.lit(None).cast("long").alias("refers"), F.lit(1).alias("turn"), "url", "payload", "size")
    system_uri = folder

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(system_uri)
        system.create_dir(f"{path}/temporary", recursive=True)
        roller, now = None, None
        for batch in batches:
            for part in (batch.slice(s, 256) for s in range(0, len(batch), 256)):
                for row in part.to_pylist():
                    if row["turn"] == 0:
                        now = row["refers"]
                        continue
                    if roller is None or roller.shard != row["shard"]:
                        if roller is not None:
                            roller.close()
                            yield _manifest_rows(roller.done)
                        roller = _Roller(system, path, row["shard"], file_bytes)
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    roller.add(record(row["id"], row["url"], row["payload"].encode(), digest, row["size"], now, now is not None))
        if roller is not None:
            roller.close()
            yield _manifest_rows(roller.done)

    dealt = (
        records.unionAll(decisions).withColumn("shard", shard)
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", F.asc_nulls_last("id"), "sha1", "turn", "url")
    )
    manifest = dealt.mapInArrow(write_shards, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return _commit(spark, folder)


def _manifest_rows(done: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in MANIFEST.split(", ")]
    columns = list(zip(*done)) or [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _commit(spark: SparkSession, folder: str) -> DataFrame:
    """Gives the manifest's files their final names; may be run again after a failure."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _open(folder)
        for files in batches:
            for temporary, name in zip(files["temporary"], files["name"]):
                if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    try:
                        system.move(f"{path}/{temporary}", f"{path}/{name}")
                    except OSError:  # another attempt of this task was first
                        if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                            raise
            yield files[["records"]]

    total = manifest.mapInPandas(rename, "records long").agg(F.count("records"), F.sum("records")).first()
    system, path = _open(folder)
    with system.open_output_stream(f"{path}/COMMITTED") as marker:
        marker.write(f"files {total[0]}\nrecords {total[1] or 0}\n".encode())
    return manifest


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().partition(":")
            fields[key.lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record of a committed folder, digests checked on the way."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        schema += ", payload string"
    names = [f.split()[0] for f in schema.split(", ")]
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import io

        system, path = _open(folder)
        for batch in batches:
            for name in batch["name"]:
                rows, held = [], 0
                with system.open_input_file(f"{path}/{name}") as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as stream:
                    for fields, block in parse(stream):
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        head, _, payload = block.partition(b"\r\n\r\n")
                        revisit = fields["warc-type"] == "revisit"
                        if f"sha1:{base32_sha1(block)}" != fields["warc-block-digest"] or not revisit and base32_sha1(payload) != digest:
                            raise ValueError(f"digest of a record in {name} is wrong")
                        page, refers = fields["x-page-id"], fields.get("x-refers-to-page-id")
                        row = (
                            None if page == "null" else int(page), fields["warc-target-uri"],
                            int(fields["x-payload-length"]), digest, fields["warc-type"], None if refers is None else int(refers),
                        )
                        rows.append((*row, payload.decode()) if with_payload else row)
                        held += len(payload)
                        if len(rows) >= 2_048 or held > 8 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                yield _frame(rows, names)

    # A task reads whole files; the number of tasks is given, as AQE would merge these few bytes of names.
    held = manifest.agg(F.count("name").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(held.files, max(spark.sparkContext.defaultParallelism, -(-held.bytes // TASK_BYTES))))
    return manifest.select("name", "sha1").repartition(tasks).mapInPandas(parse_files, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def scratch_folder(spark: SparkSession) -> str:
    """A new folder among those that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
