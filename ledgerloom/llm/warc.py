"""A deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import prefix_sums, staged

#: Payloads shorter than this are always written in full.
REVISIT_BYTES = 1000
#: Raw bytes of a shard (a range of page ids), and compressed bytes after which a file is rolled.
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
#: The date of every record: the same input gives the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach, by its URI."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member. A revisit has the headers of the full payload but not its bytes."""
    sha1 = hashlib.sha1(payload).digest()
    digest = base64.b32encode(sha1).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


class _Rolled:
    """The files of one shard: written under a temporary name, closed when large enough."""

    def __init__(self, folder: str, shard: int, limit: int) -> None:
        self.files, self.path = opened(folder)
        self.shard, self.limit, self.part, self.out, self.done = shard, limit, 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"tmp/{self.shard:08d}-{self.part:05d}-{uuid.uuid4().hex}"
            self.out = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.sum, self.size, self.records = hashlib.sha256(), 0, 0
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.shard, self.part, self.records, self.size, self.sum.hexdigest()))
            self.out, self.part = None, self.part + 1


def _write(folder: str, file_bytes: int):
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rolled, done = None, None, []
        page, responses, written = None, {}, set()
        for batch in batches:
            for i in range(batch.num_rows):
                at, page_id, sha, response, url = (batch.column(j)[i].as_py() for j in range(5))
                if at != shard:
                    if rolled:
                        rolled.close()
                        done += rolled.done
                    shard, rolled, page = at, _Rolled(folder, at, file_bytes), None
                if page is None or page[0] != page_id:
                    page, responses, written = (page_id,), {}, set()
                if sha is not None:  # a note for the page's records, sorted before them
                    responses[sha] = response
                    continue
                html = batch.column(5)[i]
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                key = hashlib.sha256(payload).hexdigest()
                refers_to = None
                if key in responses and (responses[key] != page_id or key in written):
                    refers_to = responses[key]
                written.add(key)
                rolled.add(record_bytes(page_id, url, payload, refers_to))
        if rolled:
            rolled.close()
            done += rolled.done
        columns = list(zip(*done, strict=True)) or [()] * 6
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return rows


def _commit(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        for batch in batches:
            final = []
            for name, shard, part in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
                target = f"part-{shard:08d}-{part:05d}.warc.gz"
                # A second attempt finds the file under its final name already.
                if files.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound:
                    files.move(f"{path}/{name}", f"{path}/{target}")
                final.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(final), *batch.columns[1:]], names=batch.schema.names)

    return rows


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as WARC files below ``folder`` and returns the manifest.

    Records are sorted by page_id (null last) and cut into shards of about ``shard_bytes`` by the running sum of their
    sizes, so that page ids of any kind give even shards; a shard is one task, its files are rolled at ``file_bytes``.
    Of the records with equal payloads of at least REVISIT_BYTES, the one with the largest page_id is the response,
    the others revisit it. Headers and digests are made anew; the same input gives the same files.

    A task writes under temporary names that no other attempt uses. The names that reach the manifest are those of
    successful tasks; files get their final names afterwards, and a folder is complete when ``manifest`` has been
    written. Null html is an empty payload, a null url an empty target. Rows that repeat a page_id are separate
    records; with equal payloads the first is the response. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    files, path = opened(folder)
    files.create_dir(f"{path}/tmp", recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    narrow = staged(
        rows.select("page_id", F.octet_length("html").cast("long").alias("size"), F.sha2("html", 256).alias("sha")), "payloads"
    )
    equal = narrow.filter(F.col("size") >= REVISIT_BYTES).groupBy("sha")
    equal = equal.agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    notes = narrow.filter("page_id is not null").join(equal, "sha").select("page_id", "sha", "response").distinct()
    sums = prefix_sums(narrow.select("page_id", (F.col("size") + 500).alias("size")), ["size"], ["page_id"])
    starts = sums.groupBy(F.floor(F.col("before_size") / shard_bytes).alias("shard")).agg(F.min("page_id").alias("start"))
    # One number per shard, however many rows.
    bounds = np.array(sorted({r["start"] for r in starts.collect() if r["start"] is not None}), np.int64)

    @F.udf("long", useArrow=True)
    def shard_of(page_id):
        return len(bounds) if page_id is None else max(0, int(np.searchsorted(bounds, page_id, "right")) - 1)

    nothing = F.lit(None)
    both = rows.select(
        "page_id", nothing.cast("string").alias("sha"), nothing.cast("long").alias("response"), "url", "html"
    ).unionByName(notes.select("page_id", "sha", "response", nothing.cast("string").alias("url"), nothing.cast("binary").alias("html")))
    placed = both.withColumn("shard", shard_of("page_id"))
    ordered = placed.repartition(max(1, len(bounds) + 1), "shard").sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_last(), F.col("sha").asc_nulls_last(), "url", "html"
    )
    written = ordered.select("shard", "page_id", "sha", "response", "url", "html").mapInArrow(_write(folder, file_bytes), MANIFEST)
    manifest = staged(written, "manifest").mapInArrow(_commit(folder), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    files.delete_dir(f"{path}/tmp")
    return spark.read.parquet(f"{folder}/manifest")


def parsed_records(stream, size: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of a gzip member stream, a record at a time."""
    inflate, buffer, more = zlib.decompressobj(31), bytearray(), True

    def fill() -> bool:
        nonlocal inflate, more
        raw = inflate.unused_data if inflate.eof else b""
        if inflate.eof:
            inflate = zlib.decompressobj(31)
        raw = raw or stream.read(size)
        if not raw:
            more = False
            return False
        buffer.extend(inflate.decompress(raw))
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill():
                if buffer:
                    raise ValueError("a record is cut off")
                return
        lines = bytes(buffer[:end]).decode().split("\r\n")
        headers = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        n = int(headers["content-length"])
        while len(buffer) < end + 4 + n + 4:
            if not fill():
                raise ValueError("a record is cut off")
        block = bytes(buffer[end + 4 : end + 4 + n])
        del buffer[: end + 4 + n + 4]
        yield headers, block


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Rows of all files that the manifest names. Digests and lengths of responses are checked against their bytes;
    a file that is damaged, or has another number of records than the manifest says, is an error."""
    names = [x.split()[0] for x in READ.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, held, held_bytes = 0, [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in parsed_records(stream):
                        found += 1
                        sha1 = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
                        payload = block.split(b"\r\n\r\n", 1)[1] if headers["warc-type"] == "response" else None
                        n = int(headers["x-payload-length"])
                        if payload is not None and (hashlib.sha1(payload).digest() != sha1 or len(payload) != n):
                            raise ValueError(f"{name}: payload of record {found} is damaged")
                        page, refers = headers["x-page-id"], headers.get("x-refers-to-page-id")
                        held.append((
                            int(page) if page else None, headers["warc-target-uri"], n, sha1.hex(), headers["warc-type"],
                            int(refers) if refers else None, payload if payloads else None,
                        ))
                        held_bytes += len(block) if payloads else 200
                        if held_bytes > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
                            held, held_bytes = [], 0
                if found != expected:
                    raise ValueError(f"{name}: {found} records, the manifest says {expected}")
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    manifest = spark.read.parquet(f"{folder}/manifest").select("file", "records")
    tasks = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartition(tasks).mapInArrow(rows, READ)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest, payload,
             max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND last <> page_id THEN last END AS refers_to
FROM d
"""
