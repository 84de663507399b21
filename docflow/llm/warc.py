r"""WARC archives: writing, reading, and deduplication by revisit records.

``write_archives`` turns rows into response records, one archive file (a gzip member for each record) or more for
each task, in the shared folder. ``deduplicate`` shuffles only the records' headers: the first record of each payload
digest (smallest id) is its original, found by an aggregation that combines before the shuffle, and the others are
joined to it. Each archive is then written anew: originals with fresh headers, the others as revisit records without
payload. ``read_archives`` parses archives again, and ``resolve`` joins revisit records to the responses they refer to.

Files carry the task attempt in their name and only files that a finished task reported are used, so retried or
doubled tasks do no harm. Archives are closed at ``ARCHIVE_BYTES`` and each is one row of work, streamed record by
record. Paths go through pyarrow's file systems, so the shared folder may be in any store it knows.

Defined results: a null payload is empty; a null id sorts last; repeated rows (equal id and payload) are separate
records, one original and the others revisits to it; payloads of any length are one record, held in one task's
memory; an empty table gives no archives and an empty result; other columns do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import own_dir, stored

ARCHIVE_BYTES, CHUNK, LEVEL = 64 << 20, 1 << 16, 4
#: Payloads of at least this many bytes are deduplicated.
LEAST_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "ord long, page_id long, uri string, record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, archive string, position long, length long"


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str | None) -> str:
    return " ".join((value or "").split())


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one record."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def records(file: BinaryIO) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(position, length, headers, block) of each record of an archive, read piece by piece."""
    at, rest = 0, b""
    while rest or (rest := file.read(CHUNK)):
        unzip, parts, taken = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            if not (rest := rest or file.read(CHUNK)):
                raise ValueError(f"the record at byte {at} is cut short")
            parts.append(unzip.decompress(rest))
            taken += len(rest)
            rest = b""
        rest = unzip.unused_data
        length = taken - len(rest)
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        yield at, length, headers, body[: int(headers["Content-Length"])]
        at += length


class Archives:
    """Writes records to files of a folder, a new file when one is full."""

    def __init__(self, folder: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        self.name = f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}"
        self.file, self.count = None, 0

    def add(self, data: bytes) -> tuple[str, int]:
        """The archive and position that the record went to."""
        if self.file is not None and self.file.tell() + len(data) > ARCHIVE_BYTES:
            self.close()
        if self.file is None:
            self.path = f"{self.folder}/{self.name}-{self.count:04d}.warc.gz"
            self.file, self.count = self.store.open_output_stream(self.path, compression=None), self.count + 1
        at = self.file.tell()
        self.file.write(data)
        return self.path, at

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _spread(df: DataFrame, archives: int) -> DataFrame:
    """Rows by archive, in a stated number of partitions: the rows are few bytes, but each stands for much work."""
    return df.repartition(max(1, archives), "archive")


def _open(folder: str) -> str:
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return folder


def _index(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes a response record for each row; the stored index of the records, in which ``ord`` tells rows apart."""
    _open(folder)
    own = df.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{uri_col}`").cast("string"), F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = Archives(folder), TaskContext.get().partitionId() << 40
        for batch in rows:
            index = []
            for key, uri, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                key, uri, payload = key.as_py(), _one_line(uri.as_py()), payload.as_py()
                digest, name = digest_of(payload), f"<urn:uuid:{uuid.uuid4()}>"
                headers = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Row", "" if key is None else str(key))]
                data = record("response", headers, HTTP + payload)
                path, at = out.add(data)
                index.append((n, key, uri, name, "response", None, len(payload), digest, path, at, len(data)))
                n += 1
            yield _index(index)
        out.close()

    return stored(own.mapInArrow(work, INDEX), "warc-index")


def originals(index: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(payload_digest, payload_bytes, o): for each payload its record with the smallest id."""
    first = F.struct(F.col("page_id").isNull().alias("no"), F.col("page_id").alias("id"), F.col("ord"), F.col("record_id").alias("record"), F.col("uri"))
    return index.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes").agg(F.min(first).alias("o"))


def deduplicate(spark: SparkSession, index: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes every archive of the index anew, later records of equal payloads as revisits; the stored list of new archives."""
    _open(folder)
    joined = index.join(originals(index, least).hint("merge"), ["payload_digest", "payload_bytes"], "left")
    again = F.coalesce(F.col("o.ord") != F.col("ord"), F.lit(False))
    plan = joined.select("archive", "position", "length", F.when(again, F.col("o.record")).alias("record"), F.when(again, F.col("o.uri")).alias("uri"))
    plan = _spread(plan, index.select("archive").distinct().count()).sortWithinPartitions("archive", "position")

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, source, at, made = Archives(folder), None, None, {}
        for batch in rows:
            for archive, position, length, original, uri in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != at:
                    if source is not None:
                        source.close()
                    source, at = fs.FileSystem.from_uri(folder)[0].open_input_file(archive), archive
                source.seek(position)
                _, _, headers, block = next(records(io.BytesIO(source.read(length))))
                fresh = [(k, v) for k, v in headers.items() if k.startswith(("WARC-Date", "WARC-Target", "WARC-Payload", "WARC-Record-ID", "X-"))]
                if original is None:
                    data = record("response", fresh, block)
                else:
                    cut = block.index(b"\r\n\r\n") + 4
                    fresh += [("WARC-Profile", PROFILE), ("WARC-Refers-To", original), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", DATE), ("WARC-Truncated", "length")]
                    data = record("revisit", fresh, block[:cut])
                path, _ = out.add(data)
                made[path] = made.get(path, 0) + 1
        out.close()
        if source is not None:
            source.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.string()), pa.array(list(made.values()), pa.int64())], names=["archive", "n"])

    return stored(plan.mapInArrow(work, "archive string, n long"), "warc-archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The index of the records in ``archives.archive``; payload bytes and digest of responses are of what was read."""
    spread = _spread(archives.select("archive"), archives.count())

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(folder)[0]
        for batch in rows:
            for archive in batch.column(0).to_pylist():
                index = []
                file = store.open_input_stream(archive, compression=None, buffer_size=1 << 20)
                for at, length, h, block in records(file):
                    payload = block.partition(b"\r\n\r\n")[2]
                    response = h["WARC-Type"] == "response"
                    digest = digest_of(payload) if response else h["WARC-Payload-Digest"].removeprefix("sha1:")
                    index.append((None, int(h["X-Row"]) if h["X-Row"] else None, h["WARC-Target-URI"], h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Refers-To"), len(payload) if response else None, digest, archive, at, length))
                    if len(index) == 4096:
                        yield _index(index)
                        index = []
                file.close()
                yield _index(index)

    return spread.mapInArrow(work, INDEX)


def resolve(index: DataFrame) -> DataFrame:
    """Each record with its full payload's length and digest; revisits get them from the response that they refer to.

    Headers meet by payload digest, and a revisit takes the response whose record id it names.
    """
    responses = index.where("record_type = 'response'").select("payload_digest", F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"))
    revisits = index.where("record_type = 'revisit'").select("page_id", "uri", "payload_digest", "record_type", "refers_to")
    met = revisits.join(responses.hint("merge"), ["payload_digest", "refers_to"], "left")
    back = met.select("page_id", "uri", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("_page").alias("refers_to"))
    own = index.where("record_type = 'response'").select("page_id", "uri", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(back)


def query(df: DataFrame) -> DataFrame:
    """The contract's columns: archives are written, deduplicated, read back and resolved."""
    spark = df.sparkSession
    first, second = own_dir(spark, "warc"), own_dir(spark, "warc-dedup")
    index = write_archives(df, first)
    archives = deduplicate(spark, index, second)
    return resolve(stored(read_archives(archives, second), "warc-read")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _oracle() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    v = "('0x' || substr(x, (i * 5 + 1)::bigint, 5))::bigint"
    four = " || ".join(f"substr({letters}, (({v} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
    return f"""
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, sha1(h) as x from p),
o as (select *, min(page_id) over (partition by x, payload_bytes) as first from d where payload_bytes >= {LEAST_BYTES})
select page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: {four}), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from o
"""


#: DuckDB SQL for ``query(pages)``.
ORACLE = _oracle()
