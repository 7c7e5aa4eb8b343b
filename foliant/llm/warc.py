"""WARC archives: writing, normalising monolithic gzip files, reading back.

Pages are first written as the naive tools do it: many records in one gzip stream, a file. The normaliser inflates
such a file once, as a stream, rewrites every record as a gzip member of its own and writes a sidecar index of
(offset, length, record id, type, page), so that single records can be read without what precedes them. Reading
goes through that index.

Files live in the folder that all executors share and are written through pyarrow's filesystems. Every attempt of a
task writes under a name of its own; only names that a finished task reports are read on, so a lost executor's or a
repeated task's leftovers are never seen.
"""
from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import drop_folder, scratch_path, table, written

ARCHIVE_BYTES = 32 << 20  #: payload after which a new archive is begun
LEVEL = 4
BLOCK = 1 << 18
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  #: pages carry no time of their own


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record. A revisit holds the HTTP header only; its Content-Length tells the payload's size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == REVISIT else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(url.split()))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == REVISIT:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{digest}')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode().split("\r\n")[1:]) if k}


def inflated(stream) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or more members, at most BLOCK of them at a time however well they were
    packed. A file that ends within a member is an error."""
    gz, fresh = zlib.decompressobj(31), True
    while data := stream.read(BLOCK):
        while data:
            if gz.eof:
                gz, fresh = zlib.decompressobj(31), True
            fresh = False
            yield gz.decompress(data, BLOCK)
            data = gz.unused_data if gz.eof else gz.unconsumed_tail
    while not gz.eof and (rest := gz.decompress(gz.unconsumed_tail, BLOCK)):
        yield rest
    if not (gz.eof or fresh):
        raise ValueError("the archive ends within a gzip member")


def records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and whole bytes of each record of a stream; never more than a record and a block is held."""
    held = bytearray()
    blocks = iter(blocks)

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(blocks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        at, done = held.find(b"\r\n\r\n"), False
        while at < 0:
            done = not fill(len(held) + 1)
            if done:
                break
            at = held.find(b"\r\n\r\n")
        if done:
            if held.strip():
                raise ValueError("the archive ends within a record's header")
            return
        head = _headers(bytes(held[:at]))
        size = at + 4 + int(head["content-length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends within a record")
        yield head, bytes(held[:size])
        del held[:size]


def payload_of(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record's bytes."""
    warc, _, rest = raw.partition(b"\r\n\r\n")
    head = _headers(warc)
    http, _, payload = rest[: int(head["content-length"])].partition(b"\r\n\r\n")
    return head, _headers(http), payload


def _open(path: str):
    fs, at = pafs.FileSystem.from_uri(path)
    return fs, at


def write_archives(pages: DataFrame, folder: str, smallest: int = 0) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) and return (archive, n_records) of the monolithic
    archives. Of equal payloads of at least `smallest` bytes that of the least page_id is the response, rows that
    share it too; others revisit it. Null html is an empty payload; a page without an id is always a response."""
    full = F.coalesce("html", F.lit("")).cast("binary")
    plain = pages.select("page_id", "url", full.alias("payload"), F.unhex(F.sha1(full)).alias("sha1"))
    # only digests that several pages share are looked up: few, as a rule, and then the payloads needn't be shuffled
    whole = plain.where(F.octet_length("payload") >= smallest).groupBy("sha1").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    first = written(whole.where("first <> last").select("sha1", "first"), "first")
    whose = plain.join(first, "sha1", "left").select("page_id", "url", "payload", F.when(F.octet_length("payload") >= smallest, F.col("first")).alias("first"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, done, stream, gz, size, n, name = None, [], None, None, 0, 0, ""

        def close() -> None:
            stream.write(gz.flush())
            stream.close()
            done.append((name, n))

        for batch in batches:
            for page, url, payload, least in zip(batch["page_id"], batch["url"], batch["payload"], batch["first"], strict=True):
                if stream is None or size >= ARCHIVE_BYTES:
                    if stream is not None:
                        close()
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream, gz = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                page, least = (None if pd.isna(x) else int(x) for x in (page, least))
                kind = REVISIT if page is not None and least is not None and least != page else RESPONSE
                stream.write(gz.compress(record(page, url if isinstance(url, str) else None, payload, payload_digest(payload), kind, least)))
                size += len(payload)
                n += 1
        if stream is not None:
            close()
        yield pd.DataFrame(done, columns=["archive", "n_records"])

    typed = whose.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", F.col("first").cast("string").alias("first"))
    return written(typed.mapInPandas(write, "archive string, n_records long"), "archives")


def normalise(archives: DataFrame, folder: str, target: str | None = None) -> DataFrame:
    """Rewrite each archive of (archive) in `folder` with a gzip member for every record, beside a sidecar index of
    JSON lines, in `target` (the same folder, if none is given); returns (archive, index, n_records). One pass over an
    archive, with one record held at a time."""
    target = target or folder

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (fs, base), (to_fs, to_base) = _open(folder), _open(target)
        to_fs.create_dir(to_base, recursive=True)
        for batch in batches:
            out = []
            for name in batch["archive"]:
                to, n, at = f"{uuid.uuid4().hex}.norm.warc.gz", 0, 0
                with (
                    fs.open_input_stream(f"{base}/{name}", compression=None) as source,
                    to_fs.open_output_stream(f"{to_base}/{to}", compression=None) as sink,
                    to_fs.open_output_stream(f"{to_base}/{to}.idx", compression=None) as index,
                ):
                    for head, raw in records(inflated(source)):
                        gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = gz.compress(raw) + gz.flush()
                        sink.write(member)
                        line = {"offset": at, "length": len(member), "id": head["warc-record-id"], "type": head["warc-type"], "page": head.get("x-page-id")}
                        index.write(json.dumps(line).encode() + b"\n")
                        at += len(member)
                        n += 1
                out.append((to, f"{to}.idx", n))
            yield pd.DataFrame(out, columns=["archive", "index", "n_records"])

    n = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return written(archives.select("archive").repartition(n).mapInPandas(rewrite, "archive string, index string, n_records long"), "normal")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record, found by the sidecar
    indexes of (archive, index). A response's payload is held against its digest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        for batch in batches:
            for name, index in zip(batch["archive"], batch["index"], strict=True):
                out = []
                with fs.open_input_stream(f"{base}/{index}", compression=None) as f:
                    places = [json.loads(x) for x in f.read().splitlines()]
                with fs.open_input_file(f"{base}/{name}") as f:
                    for p in places:
                        f.seek(p["offset"])
                        head, http, payload = payload_of(zlib.decompress(f.read(p["length"]), 31))
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-type"] == RESPONSE and payload_digest(payload) != digest:
                            raise ValueError(f"{name}: the payload at {p['offset']} differs from its digest")
                        out.append((head.get("x-page-id"), int(http["content-length"]), digest, head["warc-type"], head.get("x-refers-to-page-id")))
                yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)

    n = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    rows = archives.select("archive", "index").repartition(n).mapInPandas(read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))


def round_trip(pages: DataFrame, folder: str | None = None, smallest: int = 0) -> DataFrame:
    """Write, normalise and read back. A null html is an empty payload, a page without an id always a response; of
    equal payloads ties go to the least page_id, and rows that repeat it are responses too; very long pages pass one at
    a time; extra columns, whatever their names, are left behind; an empty table gives no rows."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    archives = write_archives(pages, f"{folder}/raw", smallest)
    normal = normalise(archives, f"{folder}/raw", folder)
    drop_folder(pages.sparkSession, f"{folder}/raw")  # all is in the normalised archives now
    return read_archives(normal, folder)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of pages, written to archives and read back; round_trip() says what odd rows give."""
    return round_trip(table(spark, sf_dir, "pages"))


#: The same rows in DuckDB's SQL; five hexadecimal digits make four of base 32.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
d AS (SELECT h, first, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + ((('0x' || substr(sha1(h), 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS digest FROM f)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p JOIN d USING (h)"""
