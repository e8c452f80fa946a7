"""Deterministic sharded WARC archives.

Records are range-sorted by id into shards of about equal payload, cut from exact byte counts per narrow range of ids,
so the shards depend on the records only, not on partitions or the cluster.  A task writes its shards as
streams: one gzip member per record, a new file whenever the compressed size passes the limit.  Headers are made
anew from the payload: length, SHA-1 digest, date, record id.

Commit: a file is written under a temporary name of its own and renamed when whole, and it counts only once the
manifest, which Spark commits after all tasks ended, lists it with its size and digest.  A task that runs twice
writes the same bytes to the same name; files of lost attempts are in no manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, owned, stored

DATE = "2000-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
SHARD_BYTES = 1 << 30
RANGES = 4096
MANIFEST = "file string, shard long, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str | None) -> str:
    """Safe in a header line: percent codes for control characters and the percent sign."""
    return "".join(c if c > " " and c not in "%\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, size: int, digest: str, payload: bytes, date: str) -> bytes:
    """One uncompressed record: header lines, an empty line, the payload (none for a revisit), two line ends."""
    body = payload if kind == "response" else b""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {header_value(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    else:
        lines.append(f"WARC-Block-Digest: sha1:{digest}")
    lines += ["Content-Type: application/octet-stream", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp: the same bytes for the same data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def file_system(path: str):
    from pyarrow import fs

    path = re.sub(r"^file:/(?!/)", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark resolves it: without a scheme it lies in the cluster's own file system, not on a task's disk."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


class Writer:
    """Writes one shard's records to rolled files; ``done`` has their manifest rows."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.system, self.folder = file_system(folder)
        self.shard, self.limit, self.number, self.out, self.done = shard, limit, 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.folder}/_tmp-{uuid.uuid4().hex}"
            self.out, self.records, self.bytes, self.hash = self.system.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        packed = member(data)
        self.out.write(packed)
        self.hash.update(packed)
        self.records += 1
        self.bytes += len(packed)
        if self.bytes >= self.limit:
            self.roll()

    def roll(self) -> None:
        if self.out is None:
            return
        self.out.close()
        name = f"shard-{self.shard:08d}-{self.number:05d}.warc.gz"
        self.system.move(self.temporary, f"{self.folder}/{name}")
        self.done.append((name, self.shard, self.records, self.bytes, self.hash.hexdigest()))
        self.out, self.number = None, self.number + 1


def classified(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, payload, payload_bytes, sha1, record_type, refers_to): which records repeat an equal payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    # Of equal payloads those with the largest page_id answer; counted before the shuffle, so any number of copies is fine.
    best = rows.groupBy("sha1").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    best = stored(best.select("sha1", "best", F.lit(True).alias("shared")), "warc-responses")
    joined = rows.join(best, "sha1", "left")
    answers = F.col("shared").isNull() | F.col("page_id").eqNullSafe(F.col("best")) | (F.col("payload_bytes") < least)
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "sha1", F.when(answers, "response").otherwise("revisit").alias("record_type"),
        F.when(~answers, F.col("best")).alias("refers_to"),
    )


def cells(rows: DataFrame, shard_bytes: int) -> list[tuple[int, int, int]]:
    """(shift, prefix, bytes) in the order of page_id: ids cut by their high bits until no cell but one id's is over the limit.

    A cell over the limit is cut into about eight times as many as it needs, so the cells that reach the driver are a
    small multiple of the shards.  Shifting needs no difference of ids, so ids at both ends of the range are fine.
    """
    ends = rows.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    if ends["low"] is None:
        return []
    shift = 0
    while (ends["high"] >> shift) - (ends["low"] >> shift) >= RANGES:
        shift += 1
    weight = F.sum(F.col("payload_bytes") + 512).alias("bytes")
    near, out = rows.filter("page_id is not null").select("page_id", "payload_bytes"), []
    while True:
        found = near.groupBy(F.shiftright("page_id", shift).alias("prefix")).agg(weight).collect()
        large = [r for r in found if shift and r["bytes"] > shard_bytes]
        out += [(shift, r["prefix"], r["bytes"]) for r in found if not shift or r["bytes"] <= shard_bytes]
        if not large:
            return sorted(out, key=lambda c: c[1] << c[0])
        asked = rows.sparkSession.createDataFrame([(r["prefix"],) for r in large], "prefix long")
        near = near.withColumn("prefix", F.shiftright("page_id", shift)).join(F.broadcast(asked), "prefix", "left_semi").drop("prefix")
        need = max(-(-r["bytes"] // shard_bytes) for r in large)
        shift = max(0, shift - min(12, 3 + need.bit_length()))


def shards(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``rows`` with ``shard``, and how many shards there are: ranges of page_id (null first) with about ``shard_bytes`` of payload.

    Only rows of one single id beyond the limit, or without one, are split by a hash of the record.
    """
    nulls = rows.filter("page_id is null").agg(F.sum(F.col("payload_bytes") + 512).alias("bytes")).first()["bytes"] or 0
    levels: dict[int, list[tuple[int, int, int]]] = {}
    parts = max(1, -(-nulls // shard_bytes))
    # The rows without an id have the first shards to themselves.
    shard, held = parts - 1 if nulls else -1, shard_bytes
    for shift, prefix, size in cells(rows, shard_bytes):
        if held + size > shard_bytes:
            shard, held = shard + 1, 0
        wide = max(1, -(-size // shard_bytes))
        levels.setdefault(shift, []).append((prefix, shard, wide))
        held += size
        if wide > 1:
            shard, held = shard + wide - 1, shard_bytes
    out = rows.withColumn("first", F.when(F.col("page_id").isNull(), F.lit(0).cast("long"))).withColumn("wide", F.when(F.col("page_id").isNull(), F.lit(parts).cast("long")))
    for shift, table in levels.items():
        # About as many rows as shards.
        some = F.broadcast(rows.sparkSession.createDataFrame(table, "prefix long, at long, split long"))
        out = out.withColumn("prefix", F.shiftright("page_id", shift)).join(some, "prefix", "left")
        out = out.withColumn("first", F.coalesce("first", "at")).withColumn("wide", F.coalesce("wide", "split")).drop("prefix", "at", "split")
    inside = F.pmod(F.xxhash64("page_id", "url", "sha1"), F.col("wide"))
    return out.withColumn("shard", F.col("first") + inside).drop("first", "wide"), shard + 1


def write_archive(
    pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, date: str = DATE
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files below ``folder``; returns the committed manifest.

    A record repeats another if their payloads are equal and have at least ``least`` bytes: those with the largest page_id
    are responses, all of them where several have it, and the others revisit it without a payload.  Null and empty html have an empty payload; a null page_id sorts first and never beats another.
    An empty table gives an empty manifest; other columns are ignored.
    """
    folder = qualified(pages.sparkSession, folder)
    rows, count = shards(classified(pages, least), shard_bytes)
    fields = [F.when(F.col("record_type") == "response", F.col("payload")).alias("payload")]
    sorted_rows = rows.select("shard", "page_id", "url", "record_type", "refers_to", "payload_bytes", "sha1", *fields)
    sorted_rows = sorted_rows.repartition(max(1, count), "shard").sortWithinPartitions("shard", "page_id", "url", "sha1", "record_type")
    system, place = file_system(folder)
    system.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if writer is None or writer.shard != r["shard"]:
                    if writer:
                        writer.roll()
                        done += writer.done
                    writer = Writer(folder, r["shard"], file_bytes)
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                writer.add(record(r["page_id"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], digest, r["payload"] or b"", date))
        if writer:
            writer.roll()
            done += writer.done
        names = ["file", "shard", "records", "bytes", "sha256"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*done, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    path = f"{folder.rstrip('/')}/manifest"
    sorted_rows.mapInArrow(run, MANIFEST).write.parquet(path)
    owned(pages.sparkSession).append(folder)
    return pages.sparkSession.read.schema(MANIFEST).parquet(path)


def read_records(stream) -> Iterator[dict]:
    """Records of one file, member by member; at most one record and a piece of the file are held."""
    packed, unpack, data = b"", zlib.decompressobj(31), []
    while True:
        packed = packed or stream.read(1 << 20)
        if not packed:
            break
        data.append(unpack.decompress(packed))
        packed = unpack.unused_data
        if unpack.eof:
            yield parsed(b"".join(data))
            unpack, data = zlib.decompressobj(31), []
    if any(data):
        raise ValueError("the file ends inside a record")


def parsed(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    values = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    payload = rest[: int(values["Content-Length"])]
    if rest[len(payload) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    kind, digest = values["WARC-Type"], values["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base32_sha1(payload) != digest:
        raise ValueError("a payload doesn't match its digest")
    page = lambda key: int(values[key][10:-1]) if len(values.get(key, "")) > 11 else None
    return {
        "page_id": page("WARC-Record-ID"), "url": values["WARC-Target-URI"], "record_type": kind, "refers_to": page("WARC-Refers-To"),
        "payload_bytes": int(values["X-Payload-Length"]), "payload_digest": digest, "payload": payload if kind == "response" else None,
    }


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """The RECORD rows of every file in the manifest; each file is checked against its size and digest."""
    folder = qualified(manifest.sparkSession, folder)
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [(f.split()[0], kinds[f.split()[1]]) for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed in batch.to_pylist():
                system, place = file_system(f"{folder.rstrip('/')}/{listed['file']}")
                held, size, count, seen = [], 0, 0, hashlib.sha256()
                with system.open_input_stream(place, compression=None) as raw:
                    for r in read_records(Watched(raw, seen)):
                        held.append(r)
                        size += len(r["payload"] or b"")
                        count += 1
                        if size > 8 << 20 or len(held) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], k) for n, k in fields], names=names)
                            held, size = [], 0
                if seen.hexdigest() != listed["sha256"] or count != listed["records"]:
                    raise ValueError(f"{listed['file']} is not what the manifest lists")
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], k) for n, k in fields], names=names)

    parts = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(max(parts, 8), "file").mapInArrow(run, RECORD)


class Watched:
    """A stream whose bytes also go into a hash."""

    def __init__(self, stream, seen):
        self.stream, self.seen = stream, seen

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.seen.update(data)
        return data


def archive_folder(spark) -> str:
    return fresh_path(spark, "warc")
