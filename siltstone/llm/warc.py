"""Web archives: records written and read by Spark, and revisits of payloads that an earlier record has.

An archive is a folder of WARC/1.1 files, each record a gzip member of its own.  Tasks put records together to
chunks of bounded size, and Spark's own writer commits each chunk as a file, so a lost executor leaves no
half-written archive and any file system of the cluster will do.  A file is read as one row.

Deduplication reads the headers of an archive, shuffles them by payload digest, and writes a second archive
with fresh headers: the first record of a payload stays a response, the others become revisits that name it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table
from siltstone.sources.stage import scratch_path, stage

#: Bytes of a file before compression, at most; a longer record is a file of its own.
CHUNK_BYTES = 8 << 20
#: Of gzip; higher ones cost more time than they save room.
LEVEL = 3
_FED = 1 << 16  # bytes given to a decompressor at once
#: Least payload that is worth a revisit.
LEAST_BYTES = 100

_BREAK = b"\r\n"
# Fixed values of the format.
_VERSION = b"WARC/1.1"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2020-01-01T00:00:00Z"

#: Columns of records that are written.  `payload` is null where a record has none of its own.
RECORD = "page_id string, record_id string, type string, uri string, payload binary, payload_bytes long, payload_digest string, refers_to string"
#: Columns of records that are read: those, and where they stand.
READ = f"{RECORD}, file string, at long"


def _base32(digest: str) -> str:
    return "sha256:" + base64.b32encode(bytes.fromhex(digest)).decode().rstrip("=")


def _hex(digest: str) -> str:
    text = digest.removeprefix("sha256:")
    return base64.b32decode(text + "=" * (-len(text) % 8)).hex()


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(" " if c in "\r\n" else c for c in value)


def record_bytes(record: dict) -> bytes:
    """One record: version, headers, block, and the two line breaks after it."""
    block = record["payload"] or b""
    headers = [
        ("WARC-Type", record["type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Date", _DATE),
        ("WARC-Target-URI", _clean(record["uri"]) if record["uri"] else None), ("WARC-Payload-Digest", _base32(record["payload_digest"])),
        ("WARC-Profile", _SAME_PAYLOAD if record["type"] == "revisit" else None), ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Page-ID", quote(record["page_id"], safe="") if record["page_id"] is not None else None),
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block))),
    ]
    lines = [_VERSION, *[f"{name}: {value}".encode() for name, value in headers if value is not None], b"", b""]
    return _BREAK.join(lines) + block + 2 * _BREAK


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers (names in lower case) and block of each record of a file."""
    at = 0
    while at < len(data):
        end = data.index(2 * _BREAK, at)
        version, *lines = data[at:end].split(_BREAK)
        if version != _VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in lines:
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        first = end + 2 * len(_BREAK)
        last = first + int(headers["content-length"])
        if data[last : last + 2 * len(_BREAK)] != 2 * _BREAK:
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, headers, data[first:last]
        at = last + 2 * len(_BREAK)


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Place and content of each gzip member of a file.  Zero bytes may follow the last, as gzip allows."""
    at = 0
    while at < len(data) and data[at]:
        start, content, inflate = at, [], zlib.decompressobj(31)
        while not inflate.eof:
            piece = data[at : at + _FED]
            if not piece:
                raise ValueError(f"the member at byte {start} has no end")
            content.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield start, b"".join(content)


def write(records: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write an archive of records with the columns of `RECORD`.

    A file has `chunk_bytes` at most before compression, or one longer record.  No records make an archive
    without files.
    """

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for k in range(batch.num_rows):
                data = record_bytes(batch.slice(k, 1).to_pylist()[0])
                if held and size + len(data) > chunk_bytes:
                    yield _chunk(held)
                    held, size = [], 0
                held.append(gzip.compress(data, LEVEL, mtime=0))
                size += len(data)
        if held:
            yield _chunk(held)

    def _chunk(held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    columns = [c.split()[0] for c in RECORD.split(", ")]
    chunks = records.select(*columns).mapInArrow(put, "value binary").select(F.col("value").cast("string"))
    # the text writer puts bytes as they are and ends the one row of a file with its separator: a zero byte, which
    # gzip takes for padding
    chunks.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of an archive with the columns of `READ`.  Digest and bytes are those of the block where there is
    one, and what the header says for a revisit (whose bytes its response has)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64(), "at": pa.int64()}
        columns = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = []
                for at, headers, block in ((at, h, b) for at, member in members(content.as_py()) for _, h, b in parse(member)):
                    full = headers["warc-type"] == "response"
                    rows.append({
                        "page_id": unquote(headers["warc-page-id"]) if "warc-page-id" in headers else None, "record_id": headers["warc-record-id"], "type": headers["warc-type"], "uri": headers.get("warc-target-uri"),
                        "payload": block if full and payloads else None, "payload_bytes": len(block) if full else None,
                        "payload_digest": hashlib.sha256(block).hexdigest() if full else _hex(headers["warc-payload-digest"]),
                        "refers_to": headers.get("warc-refers-to"), "file": name.as_py(), "at": at,
                    })
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in columns], names=columns)

    return files.mapInArrow(take, READ)


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A response for every row: null html is an empty payload, and each record has an id of its own."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(page_id).cast("string").alias("page_id"), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("record_id"), F.lit("response").alias("type"),
        F.col(url).cast("string").alias("uri"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"), F.lit(None).cast("string").alias("refers_to"),
    )


def deduplicate(spark: SparkSession, source: str, target: str, order: str = "long", least_bytes: int = LEAST_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write the archive `source` to `target` without repeated payloads.

    Of responses with equal payloads of at least `least_bytes`, that with the smallest page id (as type `order`;
    ids that are not of that type or absent come last, then record ids decide) stays; the others become
    revisits without a block that refer to it.  All records get fresh headers and keep their ids.  Only
    headers are shuffled by digest, after a partial aggregation; payloads move once, by record id.
    """
    place = lambda: F.struct(F.col("page_id").try_cast(order).isNull().alias("last"), F.col("page_id").try_cast(order).alias("page"), F.col("record_id").alias("record"))
    headers = stage(read(spark, source, payloads=False).select("record_id", "page_id", "payload_bytes", "payload_digest"), "headers")
    firsts = stage(headers.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min(place()).alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", F.col("first.record").alias("first_record")), "firsts")
    revisits = headers.join(firsts, "payload_digest").where("record_id <> first_record").select(F.col("record_id").alias("revisit_id"), "first_record")
    full = read(spark, source)
    resolved = full.join(stage(revisits, "revisits"), F.col("record_id") == F.col("revisit_id"), "left")
    again = F.col("revisit_id").isNotNull()
    write(
        resolved.select(
            "page_id", "record_id", F.when(again, "revisit").otherwise(F.col("type")).alias("type"), "uri", F.when(~again, F.col("payload")).alias("payload"),
            "payload_bytes", "payload_digest", F.when(again, F.col("first_record")).otherwise(F.col("refers_to")).alias("refers_to"),
        ),
        target, chunk_bytes,
    )


def resolve(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive, a revisit with the bytes and page id of the response it refers to, after
    checking that the digests agree: `page_id`, `record_id`, `type`, `uri`, `payload_bytes`, `payload_digest`,
    `refers_to_page`.  A revisit whose response is missing or differs has null bytes."""
    records = stage(read(spark, path, payloads=False).drop("payload"), "records")
    responses = records.where("type = 'response'").select(
        F.col("record_id").alias("response_id"), F.col("page_id").alias("response_page"), F.col("payload_bytes").alias("response_bytes"), F.col("payload_digest").alias("response_digest")
    )
    met = records.join(responses, (F.col("refers_to") == F.col("response_id")) & (F.col("payload_digest") == F.col("response_digest")), "left")
    return met.select("page_id", "record_id", "type", "uri", F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"), "payload_digest", F.col("response_page").alias("refers_to_page"))


# --- query


def archived(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write `pages` to the archive `folder`/raw and, without repeated payloads, to `folder`/unique; return what
    reading that gives: `page_id`, `payload_bytes`, `payload_digest` (hex SHA-256), `record_type` and `refers_to`.

    One row for each row of `pages`, repeated ones too; null html is an empty payload, and a null page id stays null
    and is a response only if no page with the payload has an id.  Other columns are ignored.  Runs jobs.
    """
    spark = pages.sparkSession
    kind = pages.select(page_id).schema[0].dataType.simpleString()
    write(page_records(pages, page_id, url, html), f"{folder}/raw", chunk_bytes)
    deduplicate(spark, f"{folder}/raw", f"{folder}/unique", kind, least_bytes, chunk_bytes)
    found = resolve(spark, f"{folder}/unique")
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_to_page").cast(kind).alias("refers_to"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""
