"""WARC archives: one gzip member per record, written by Spark tasks and read back sequentially.

Equal payloads of at least MIN_REVISIT bytes are stored once: the record with
the smallest id is a `response`, the others are `revisit` records that name it.

Defined cases: a null payload is empty. A null id makes a record without id,
which is never the one that others refer to. Rows that repeat an id are
records of their own; where they have the smallest id of a payload, all of
them are responses. No rows give an empty archive and no rows back.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.shared import open_fs, prepare, read_files, shared_folder, stored, unique_file

MIN_REVISIT = 100
SALTS = 32
FILE_BYTES = 1 << 30
READ_BYTES = 1 << 20

RECORD_SCHEMA = "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """Rows id, url, payload, digest, refers_to: the id that a revisit refers to.

    Digests are aggregated first (minima combine before the shuffle). A payload
    that a third of all rows share is joined over SALTS keys.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    firsts = (
        rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").select("digest", "first")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    joined = rows.join(firsts, ["digest", "salt"], "left")
    return joined.select("id", "url", "payload", "digest", F.when(F.col("first") != F.coalesce("id", F.lit(-1) + F.col("first")), F.col("first")).alias("refers_to"))


def _header(value: str | None) -> str:
    return (value or "").replace("\r", "%0D").replace("\n", "%0A").replace("\0", "%00")


def encode_record(id_: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if id_ is None else id_}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write all rows to archives in the folder; returns the manifest (file, records, bytes)."""
    prepare(pages.sparkSession)

    def write(batches):
        out, name, records, size = None, None, 0, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                if out is None:
                    name, records, size = unique_file(folder, ".warc.gz"), 0, 0
                    system, path = open_fs(name)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                member = encode_record(*(c[i].as_py() for c in columns))
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})

    marked = mark_revisits(pages, id_col, url_col, body_col)
    return stored(marked.mapInArrow(write, "file string, records long, bytes long"), "warc-manifest")


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator over its inflated parts, never held whole."""
    rest = b""

    def parts():
        nonlocal rest
        inflate = zlib.decompressobj(31)
        while True:
            yield inflate.decompress(rest, READ_BYTES)
            rest = inflate.unconsumed_tail
            while rest:
                yield inflate.decompress(rest, READ_BYTES)
                rest = inflate.unconsumed_tail
            if inflate.eof:
                rest = inflate.unused_data
                return
            rest = next(chunks, None)
            if rest is None:
                rest = b""
                if more := inflate.decompress(b"", READ_BYTES):
                    yield more
                if not inflate.eof:
                    raise ValueError("archive ends inside a record")

    while True:
        while not rest:
            rest = next(chunks, None)
            if rest is None:
                return
        one = parts()
        yield one
        for _ in one:
            pass


class _Framed:
    """Reads lines and exact lengths from the parts of a member."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.buffer = parts, b""

    def line(self) -> str:
        while b"\r\n" not in self.buffer:
            more = next(self.parts, None)
            if more is None:
                raise ValueError("record header is cut off")
            self.buffer += more
        line, self.buffer = self.buffer.split(b"\r\n", 1)
        return line.decode()

    def headers(self) -> dict[str, str]:
        found = {}
        while line := self.line():
            name, _, value = line.partition(":")
            found[name.lower()] = value.strip()
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer:
                self.buffer = next(self.parts, None)
                if self.buffer is None:
                    raise ValueError("record is shorter than its content length")
            part, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(part)
            if part:
                yield part


def _id(header: str | None) -> int | None:
    digits = (header or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_record(parts: Iterator[bytes], with_payload: bool = True) -> dict:
    """One record: headers, framing by content length, digest of the payload as it streams by."""
    framed = _Framed(parts)
    if framed.line() != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    head = framed.headers()
    length = int(head["content-length"])
    kind, stated = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
    block = _Framed(framed.exactly(length))
    block.line()
    size = int(block.headers()["content-length"])
    digest, kept = hashlib.sha256(), []
    if kind == "response":
        for part in block.exactly(size):
            digest.update(part)
            if with_payload:
                kept.append(part)
    if block.buffer or next(block.parts, None) is not None:
        raise ValueError("record is longer than its HTTP message")
    if b"".join(framed.exactly(4)) != b"\r\n\r\n":
        raise ValueError("record does not end where its content length says")
    return {
        "id": _id(head["warc-record-id"]), "url": head.get("warc-target-uri"), "record_type": kind, "refers_to": _id(head.get("warc-refers-to")),
        "payload_bytes": size, "payload_digest": stated, "digest_ok": kind == "revisit" or digest.hexdigest() == stated,
        "payload": b"".join(kept) if with_payload and kind == "response" else None,
    }


_ARROW = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("payload", pa.binary())])


def read_archive(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives in a manifest (column file), one task per archive, in RECORD_SCHEMA.

    A broken frame fails the job; a payload that does not have its digest has digest_ok false.
    """
    prepare(manifest.sparkSession)

    def read(name):
        system, path = open_fs(name)
        with system.open_input_stream(path, compression=None) as stream:
            rows, held = [], 0
            for parts in members(iter(lambda: stream.read(READ_BYTES) or None, None)):
                rows.append(read_record(parts, with_payload))
                held += len(rows[-1]["payload"] or b"") + 200
                if held > 4 * READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return read_files(manifest, read, RECORD_SCHEMA)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = write_archive(pages, shared_folder(spark, "warc"))
    back = read_archive(manifest, with_payload=False)
    checked = back.withColumn("payload_digest", F.when(F.col("digest_ok"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload does not have its digest"))))
    return checked.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest,
    min(page_id) OVER (PARTITION BY body) AS first_id
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
