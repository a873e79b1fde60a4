"""WARC archives written and read by Spark tasks.

Records are sorted by url and id over all shards. Each shard is a range of that order, whose bounds follow
from the data alone, and rolls to a next file when the compressed size is reached. Headers, record ids and
digests are made anew from the payload, so the same rows give the same bytes. A task writes under a
name of its own attempt and reports its files; only files of the manifest are renamed and read, so a repeated
or lost task leaves nothing that counts.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.llm.common import arrow_schema
from powerflow.llm.shared_files import exists, new_folder, open_store
from powerflow.session import written

REVISIT_BYTES = 1000  # equal payloads from this size on are stored once
SHARD_BYTES = 128 << 20  # payload of one task
FILE_BYTES = 1 << 30  # compressed size at which a file is closed
SAMPLES_PER_SHARD = 64  # keys that settle the shards' bounds
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # the archive's date is a parameter, or equal rows would give other bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, attempt string, records long, bytes long, sha256 string"


def with_record_types(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with payload, digest, and the record that a revisit refers to.

    Of equal payloads of at least ``least_bytes`` bytes the one with the largest id is stored; rows that repeat
    its id are stored too. Only groups of several rows are joined, by digest and size.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
    )
    groups = written(
        rows.filter(F.col("size") >= least_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("refers_url"), F.count("*").alias("n"))
        .filter("n > 1").drop("n"),
        "payload-groups",
    )
    joined = rows.join(groups, ["digest", "size"], "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select(
        "page_id", "url", "digest", "size", F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.when(revisit, F.col("refers_url")).alias("refers_url"),
    )


def _sort_key() -> Column:
    number = F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0")
    return F.concat(F.coalesce("url", F.lit("")), F.lit("\x00"), number)


def _bounds(records: DataFrame, shards: int) -> list[str]:
    """Keys that part the shards, from those with the smallest hashes: bounded, and the same each time."""
    keys = records.select(_sort_key().alias("key"))
    sample = keys.orderBy(F.xxhash64("key"), "key").limit(shards * SAMPLES_PER_SHARD).collect()
    ordered = sorted(row["key"] for row in sample)
    return [ordered[len(ordered) * i // shards] for i in range(1, shards)] if ordered else []


def _record_id(page_id: int | None, url: str | None) -> str:
    name = hashlib.sha256(repr((page_id, url)).encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=name, version=5)}>"


def _field(value: str) -> str:
    """A header value without controls or blanks, which would end it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    fields = [*fields, ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(head.encode() + block + b"\r\n\r\n") + member.flush()


def page_record(row: dict, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    revisit = row["refers_to"] is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(row["page_id"], row["url"]))]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _field(row["url"])))
    fields += [
        ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _base32(bytes.fromhex(row["digest"]))),
    ]
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(row["refers_to"], row["refers_url"])),
            ("X-Refers-To-Page-ID", str(row["refers_to"])),
        ]
        if row["refers_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", _field(row["refers_url"])))
    return record_bytes(fields, http.encode() + (b"" if revisit else row["payload"].encode()))


class _Shard:
    """Files of one shard, written under names of this attempt."""

    def __init__(self, folder: str, shard: int, file_bytes: int, date: str):
        self.store, self.path = open_store(folder)
        self.shard, self.file_bytes, self.date = shard, file_bytes, date
        self.number, self.out = 0, None

    def open(self) -> None:
        self.name = f"shard-{self.shard:05d}-{self.number:05d}.warc.gz"
        self.attempt = f".{self.name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(f"{self.path}/{self.attempt}", compression=None)
        self.records, self.size, self.sha = 0, 0, hashlib.sha256()
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, self.name)), ("WARC-Date", self.date),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self.put(record_bytes(info, b"format: WARC File Format 1.1\r\n"))

    def put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def add(self, row: dict) -> dict | None:
        if self.out is None:
            self.open()
        self.put(page_record(row, self.date))
        self.records += 1
        return self.close() if self.size >= self.file_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.number += 1
        return {"file": self.name, "attempt": self.attempt, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest()}


def write_archives(
    pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, date: str = DATE
) -> DataFrame:
    """Write the pages and return the manifest: ``file``, ``records``, ``bytes``, ``sha256``.

    An empty table gives an empty manifest. NULL html is an empty payload; a NULL id or url has no header field.
    """
    spark = pages.sparkSession
    records = with_record_types(pages)
    payload = records.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-payload // shard_bytes))
    bounds = spark.sparkContext.broadcast(np.array(_bounds(records, shards), dtype=object))

    @F.arrow_udf("int")
    def shard_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds.value, keys.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    arrow = arrow_schema(MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if shard is None or row["shard"] != shard.shard:
                    done.append(shard and shard.close())
                    shard = _Shard(folder, row["shard"], file_bytes, date)
                done.append(shard.add(row))
            yield pa.RecordBatch.from_pylist([d for d in done if d], schema=arrow)
        if shard is not None and (last := shard.close()):
            yield pa.RecordBatch.from_pylist([last], schema=arrow)

    key = _sort_key()
    sorted_rows = (
        records.withColumn("shard", shard_of(key)).repartitionById(shards, F.col("shard"))  # a shard is a task
        .sortWithinPartitions("shard", key, "digest")
    )
    manifest = written(sorted_rows.mapInArrow(write, MANIFEST), "warc-manifest")
    return commit(manifest, folder)


def commit(manifest: DataFrame, folder: str) -> DataFrame:
    """Give the manifest's files their names. May be repeated: a file that has its name is left."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if not exists(store, f"{path}/{row['file']}"):
                    store.move(f"{path}/{row['attempt']}", f"{path}/{row['file']}")
            yield batch

    return written(manifest.mapInArrow(rename, MANIFEST), "warc-committed").drop("attempt")


def _members(stream) -> Iterator[bytes]:
    """Records of an archive; one is held at a time."""
    member, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(READ_BYTES)
        if not data:
            if parts:
                raise ValueError("the archive ends within a record")
            return
        parts.append(member.decompress(data))
        data = member.unused_data
        if member.eof:
            yield b"".join(parts)
            member, parts = zlib.decompressobj(31), []


def parse_record(record: bytes) -> dict:
    """Header fields by lower-case name, the block, and the payload length and digest it declares."""
    head, rest = record.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8").split("\r\n")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if fields["warc-block-digest"] != _base32(hashlib.sha1(block).digest()):
        raise ValueError(f"the block digest of {fields['warc-record-id']} is wrong")
    return {"fields": fields, "block": block}


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """A row for each page record, read back and checked against its digests."""
    schema = (
        "page_id long, url string, payload string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    arrow = arrow_schema(schema)

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        fields, block = (found := parse_record(record))["fields"], found["block"]
                        if fields["warc-type"] == "warcinfo":
                            continue
                        http, payload = block.split(b"\r\n\r\n", 1)
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
                        stored = fields["warc-type"] == "response"
                        if stored and hashlib.sha1(payload).digest() != digest:
                            raise ValueError(f"the payload digest of {fields['warc-record-id']} is wrong")
                        rows.append({
                            "page_id": number(fields.get("x-page-id")), "url": fields.get("warc-target-uri"),
                            "payload": payload.decode("utf-8") if stored else None,
                            "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
                            "payload_digest": digest.hex(), "record_type": fields["warc-type"],
                            "refers_to": number(fields.get("x-refers-to-page-id")),
                        })
                        held += len(payload)
                        if held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(read, schema)
