"""Deterministic sharded WARC writer, and its reader.

Records are sorted by page over ranges; each range is a shard, written by one task as a row of
gzip-compressed files. Ranges follow from exact counts of rows per range of ids, so the same rows give
the same files whatever the partitions of the input or of the cluster. Every record is a gzip member of its own, with headers made anew from the
record: type, length, digests, and an id that follows from page and payload. A file is closed once
its compressed size reaches ``roll_bytes``. It is written under a temporary name that only this
attempt uses and renamed when complete; the names of complete files are a manifest table, and only
files of the manifest are read. A task that runs again writes the same bytes under the same name.

Of records with equal payloads the one with the largest ``page_id`` is the response, the others
are revisits that refer to it, if the payload has at least ``least_bytes``. How often a payload
occurs is summed before the shuffle, lookups of frequent payloads are salted and take ids and
hashes only; payloads are exchanged once, for the range sort.

Null payloads are empty, null urls empty, repeated rows are records of their own (of several rows
with the largest ``page_id`` one is the response). Rows without ``page_id`` are written as
responses unless a row with an id has their payload. Other columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import written

ROLL_BYTES = 64 << 20
READ_BYTES = 256 << 20  # archives that one task reads
SHARDS = 8192  # about the most shards; bounds how much of the ranges the driver sees
SHARD_ROWS = 2048  # rows of a shard at least, where there are fewer
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
LINE_END = b"\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard one for URLs
_FORBIDDEN = re.compile(r"[\x00-\x20\x7f]")

MANIFEST = "file string, n_records bigint, n_bytes bigint, sha256 string"
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}:{payload_digest}')}>"


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and the payload's hash."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha", F.unhex(F.sha2("payload", 256)))


def targets(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha and the page with the response, for payloads that occur more than once. Only
    ids and hashes are exchanged."""
    keys = rows.where(F.octet_length("payload") >= least_bytes).select(
        "page_id", "sha", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt")
    )
    frequent = (
        keys.groupBy("sha")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("response_id").isNotNull())
        .select("sha", "response_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        .withColumn("salt", F.col("salt").cast("long"))
    )
    return keys.join(frequent, ["sha", "salt"]).select("page_id", "sha", "response_id")


class Ranges(NamedTuple):
    """First ids of ranges in order (the range before them is that of null ids), for each the number
    of its first shard, and how many shards it is cut into by hash: more than one where a single id
    has more rows than a shard."""

    firsts: np.ndarray
    shards: np.ndarray
    parts: np.ndarray


def ranges(rows: DataFrame) -> Ranges:
    """Cells of equal width are counted; those with more rows than a shard are cut in sixteen and
    counted again until they hold one id. Neighbours are put together up to a shard's rows. The
    driver sees numbers of cells, bounded by multiples of ``SHARDS``."""
    lowest, highest, total, nulls = rows.agg(
        F.min("page_id"), F.max("page_id"), F.count("*"), F.count_if(F.col("page_id").isNull())
    ).first()
    target = max(SHARD_ROWS, -(-total // SHARDS))
    shift = 0
    while lowest is not None and (highest >> shift) - (lowest >> shift) > 2 * SHARDS:
        shift += 4
    cells: list[tuple[int, int]] = []  # first id, rows
    ids = rows.where("page_id IS NOT NULL").select("page_id")
    while lowest is not None:
        cell = F.shiftright("page_id", shift).alias("cell")
        counts = [tuple(r) for r in ids.groupBy(cell).count().collect()]
        heavy = [c for c, n in counts if n > target and shift]
        cells += [(c << shift, n) for c, n in counts if n <= target or not shift]
        if not heavy:
            break
        chosen = ids.sparkSession.createDataFrame([(c,) for c in heavy], "cell bigint")
        ids = ids.withColumn("cell", cell).join(F.broadcast(chosen), "cell").select("page_id")
        shift -= 4
    firsts, parts, held = [], [max(1, -(-nulls // target))], target
    for first, n in sorted(cells):
        if held + n > target:
            firsts.append(first)
            parts.append(max(1, -(-n // target)))
            held = 0
        held += n
    shards = np.cumsum([0, *parts])[:-1]
    return Ranges(np.array(firsts, np.int64), shards, np.array(parts, np.int64))


def shard_of(found: Ranges) -> Column:
    """The shard of a row with page_id and sha."""

    @F.pandas_udf("long")
    def shard(page_id: pd.Series, start: pd.Series) -> pd.Series:
        place = np.zeros(len(page_id), np.int64)
        known = page_id.notna().to_numpy()
        ids = page_id[known].astype("int64").to_numpy()
        place[known] = np.searchsorted(found.firsts, ids, side="right")
        return pd.Series(found.shards[place] + (start.to_numpy() * found.parts[place] >> 32))

    # As text, since pandas would turn ids beside nulls into doubles.
    start = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    return shard(F.col("page_id").cast("string"), start)


def headers(fields: dict[str, str]) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields.items())]
    return LINE_END.join(lines) + LINE_END * 2


def record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    """One record; a revisit has no payload but the digest of the full one."""
    own = digest(payload)
    body = b"" if refers_to is not None else payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, own),
        "WARC-Date": DATE,
        "WARC-Target-URI": _FORBIDDEN.sub(lambda m: quote(m[0]), url),
        "WARC-Payload-Digest": f"sha1:{own}",
        "WARC-Block-Digest": f"sha1:{digest(body)}",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload)),
    }
    if refers_to is not None:
        fields |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(refers_to, own),
            "X-Refers-To-Page-ID": str(refers_to),
        }
    fields |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(body))}
    return headers(fields) + body + LINE_END * 2


class Roll:
    """Files of one shard: opened under a temporary name, renamed when full."""

    def __init__(self, folder: str, shard: int, attempt: int, roll_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.roll_bytes = shard, attempt, roll_bytes
        self.number, self.out = 0, None

    def add(self, data: bytes) -> dict | None:
        """Write a record; the manifest row of the file, if that closed it."""
        if self.out is None:
            self.name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{self.attempt}.tmp"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.n_records = self.n_bytes = 0
            self.sha = hashlib.sha256()
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.n_records += 1
        self.n_bytes += len(member)
        return self.close() if self.n_bytes >= self.roll_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.store.move(self.temporary, f"{self.path}/{self.name}")
        self.out = None
        self.number += 1
        return {
            "file": self.name, "n_records": self.n_records, "n_bytes": self.n_bytes,
            "sha256": self.sha.hexdigest(),
        }


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``folder``, a URI that driver and executors share; the manifest."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    rows = payloads(pages)
    # What a page refers to travels to the page's shard as a row of its own, ahead of the page.
    known = targets(rows, least_bytes).select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        "sha", "response_id",
    )
    found = ranges(pages.select(F.col("page_id").cast("long").alias("page_id")))
    sorted_rows = (
        rows.withColumn("response_id", F.lit(None).cast("long"))
        .unionByName(known)
        .withColumn("shard", shard_of(found))
        .repartition("shard")
        .sortWithinPartitions("shard", "page_id", "sha", F.col("payload").isNotNull(), "url")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        roll = None
        current, target, responded = None, None, False
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, payload, sha, response_id, shard = (
                    batch.column(name)[row].as_py()
                    for name in ("page_id", "url", "payload", "sha", "response_id", "shard")
                )
                if roll is None or roll.shard != shard:
                    if roll is not None and (done := roll.close()):
                        yield pa.RecordBatch.from_pylist([done])
                    roll = Roll(folder, shard, attempt, roll_bytes)
                if payload is None:
                    current, target, responded = (page_id, sha), response_id, False
                    continue
                refers_to = target if (page_id, sha) == current else None
                if refers_to is not None and refers_to == page_id and not responded:  # of equal rows the first responds
                    refers_to, responded = None, True
                done = roll.add(record(page_id, url, payload, refers_to))
                if done:
                    yield pa.RecordBatch.from_pylist([done])
        if roll is not None and (done := roll.close()):
            yield pa.RecordBatch.from_pylist([done])

    return written(sorted_rows.mapInArrow(run, MANIFEST), "warc-manifest")


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of one archive, one at a time; a wrong digest or length is an error."""
    data = gzip.GzipFile(fileobj=stream)
    while version := data.readline():
        if version != b"WARC/1.1" + LINE_END:
            raise ValueError(f"no WARC record starts here: {version[:40]!r}")
        fields = {}
        while (line := data.readline()) != LINE_END:
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        body = data.read(int(fields["Content-Length"]))
        if data.read(4) != LINE_END * 2 or f"sha1:{digest(body)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        number = lambda name: int(fields[name]) if fields.get(name) else None
        yield {
            "page_id": number("X-Page-ID"),
            "url": fields["WARC-Target-URI"],
            "payload_bytes": number("X-Payload-Length"),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": fields["WARC-Type"],
            "refers_to": number("X-Refers-To-Page-ID"),
            "payload": body,
        }


_RECORD = pa.schema(
    [
        (name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
        for name, kind in (part.split() for part in RECORD.split(", "))
    ]
)


def read(manifest: DataFrame, folder: str, columns: tuple[str, ...] = tuple(_RECORD.names)) -> DataFrame:
    """The records of all files of a manifest."""
    schema = pa.schema([_RECORD.field(name) for name in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for found in parse(stream):
                        rows.append({k: found[k] for k in columns})
                        held += len(found["payload"])
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spark_schema = ", ".join(p for p in RECORD.split(", ") if p.split()[0] in columns)
    # The manifest is small whatever the archives hold, so tasks are counted from their bytes.
    total = manifest.agg(F.count("*").alias("files"), F.sum("n_bytes").alias("bytes")).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(total["files"], cores), -(-(total["bytes"] or 0) // READ_BYTES))
    files = manifest.select("file").repartitionByRange(tasks, "file")
    return files.mapInArrow(run, spark_schema)
