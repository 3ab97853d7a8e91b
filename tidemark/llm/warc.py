"""WARC archives: writing pages as records, reading records back, and resolving revisits.

``write_archives`` makes one response record per row. ``resolve_revisits`` reads such archives, moves
only headers by payload digest, names for every digest the record with the smallest page id, joins the
decision to the records, and writes new archives in which every other record of that digest is a
revisit: it refers to the original and has fresh headers and no payload. A digest's headers are reduced
to one before they move, and the join back is between written tables, so copies of one payload that make
up much of the input do not meet in one task.

Archives are WARC/1.1 files, gzipped as a whole, of about ``archive_bytes`` each before that, or one record
if that is longer. They are written and read with Spark's own sources in the shared folder. A record is delimited by
its Content-Length alone, so payloads may hold anything.

A null payload counts as empty. A null page id comes last among equal payloads and its record has no such
header; of equal ids, the earlier record counts as smaller. Line breaks and other control characters in a
url are percent-encoded, a null url leaves the header out. Payloads shorter than ``least_bytes`` are never
revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ready_for_python
from tidemark.sources.shared import own_path, stage

ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = (
    "place string, offset bigint, record_id string, record_type string, page_id bigint, url string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, refers_record string"
)
_IDS = uuid.UUID("9d3f0f0c-5a0e-5c86-9f0b-0c9e7f6a1d21")  # the name space of record ids


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record_id(*parts: object) -> str:
    """The same for the same parts, so that a repeated task or run gives the same ids."""
    return f"<urn:uuid:{uuid.uuid5(_IDS, ' '.join(map(str, parts)))}>"


def fresh_id(old: str) -> str:
    """The id of a record that is written anew, from that of the record it is made from."""
    return record_id("anew", old)


def record(
    kind: str, own_id: str, page_id: int | None, url: str | None, size: int, digest: str, payload: bytes, refers: dict[str, object]
) -> bytes:
    """One record without the last of the two line ends that close it, which the file's writer adds."""
    block = _http(size) + payload
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": own_id,
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _safe(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{digest_of(block)}",
        **refers,
        "X-Page-Id": page_id,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _number(value: object) -> int | None:
    return None if pd.isna(value) else int(value)


def _text(value: object) -> str | None:
    return value if isinstance(value, str) else None


def _blocks(records: Iterator[bytes], most: int) -> Iterator[pd.DataFrame]:
    """Records joined to blocks of at most ``most`` bytes, or of one longer record."""
    held, size = [], 0
    for one in records:
        if held and size + len(one) > most:
            yield pd.DataFrame({"block": [b"".join(held)[:-2]]})
            held, size = [], 0
        held.append(one)
        size += len(one)
    if held:
        yield pd.DataFrame({"block": [b"".join(held)[:-2]]})


def _write(blocks: DataFrame, folder: str) -> str:
    """One file per block; the writer ends each with the line end that the block lacks."""
    lines = blocks.select(F.col("block").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n").option("maxRecordsPerFile", 1).option("compression", "gzip").text(folder)
    return folder


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES
) -> str:
    """Write a response record per row of ``pages`` and return the folder."""
    ready_for_python(pages.sparkSession)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[bytes]:
            task, n = TaskContext.get().partitionId(), 0
            for batch in batches:
                for page_id, url, payload in zip(batch["page_id"], batch["url"], batch["payload"], strict=True):
                    own, digest = None if page_id is None else int(page_id), digest_of(payload)
                    # Rows may repeat, so their place in the table counts as well.
                    yield record("response", record_id(task, n, own, digest), own, _text(url), len(payload), digest, payload, {})
                    n += 1

        yield from _blocks(records(), archive_bytes)

    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    # As text, so that a null id stays one.
    ids = F.col(id_col).cast("string").alias("page_id")
    rows = pages.select(ids, F.col(url_col).alias("url"), payload.alias("payload"))
    return _write(rows.mapInPandas(make, "block binary"), folder)


@dataclass(frozen=True)
class Record:
    offset: int
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def parse(archive: bytes) -> Iterator[Record]:
    """The records of an archive, one after the other by their Content-Length."""
    at = 0
    while at < len(archive):
        if not archive.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = archive.index(b"\r\n\r\n", at)
        fields = _fields(archive[at:end])
        block = archive[end + 4 : end + 4 + int(fields["content-length"])]
        split = block.index(b"\r\n\r\n")
        yield Record(at, fields, _fields(block[:split]), block[split + 4 :])
        at = end + 4 + len(block) + 4


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    ready_for_python(spark)
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("place"), "content")


def _whole(value: str | None) -> int | None:
    return None if value is None else int(value)


def _header(place: str, r: Record) -> tuple:
    return (
        place,
        r.offset,
        r.fields["warc-record-id"],
        r.fields["warc-type"],
        r.fields.get("x-page-id"),
        r.fields.get("warc-target-uri"),
        int(r.http["content-length"]),
        r.fields["warc-payload-digest"].removeprefix("sha1:"),
        r.fields.get("x-refers-to-page-id"),
        r.fields.get("warc-refers-to"),
    )


_NAMES = ["place", "offset", "record_id", "record_type", "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "refers_record"]


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``; payloads stay where they are."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["place"], batch["content"], strict=True):
                yield pd.DataFrame([_header(place, r) for r in parse(gzip.decompress(content))], columns=_NAMES)

    as_text = HEADERS.replace("page_id bigint", "page_id string").replace("refers_to bigint", "refers_to string")
    found = _archives(spark, folder).mapInPandas(read, as_text)
    return found.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def resolve_revisits(
    spark: SparkSession, folder: str, into: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> str:
    """Write the archives of ``folder`` anew to ``into``, each payload once, and return ``into``.

    Of responses with equal payloads of ``least_bytes`` or more the first stays one, by page id, and the
    others become revisits of it. Revisits that are there already, of any size, refer to that response as
    well; one whose response is in none of the archives stays as it is. All records get new ids, which
    are made from the old ones, so that a revisit knows that of its response.
    """
    headers = stage(read_headers(spark, folder), "headers")
    # Nulls would come first in a struct.
    order = F.struct(F.col("page_id").isNull(), "page_id", "place", "offset", "record_id", "url")
    responses = F.min(F.when(F.col("record_type") == "response", order)).alias("first")
    first = headers.groupBy("payload_digest").agg(responses, F.count("*").alias("copies")).where("copies > 1 and first is not null")
    first = stage(first.select("payload_digest", "first"), "originals")
    able = headers.where((F.col("payload_bytes") >= least_bytes) | (F.col("record_type") == "revisit"))
    decided = able.select("place", "offset", "payload_digest").join(first, "payload_digest")
    is_first = (F.col("place") == F.col("first.place")) & (F.col("offset") == F.col("first.offset"))
    revisits = decided.where(~is_first).select(
        F.col("place").alias("at_place"),
        F.col("offset").alias("at_offset"),
        F.col("first.record_id").alias("original"),
        F.col("first.url").alias("original_url"),
        F.col("first.page_id").cast("string").alias("original_page"),
    )
    revisits = stage(revisits, "revisits")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["place"], batch["content"], strict=True):
                rows = [(*_header(place, r), r.payload) for r in parse(gzip.decompress(content))]
                yield pd.DataFrame(rows, columns=[*_NAMES, "payload"])

    as_text = HEADERS.replace("page_id bigint", "page_id string").replace("refers_to bigint", "refers_to string")
    records = _archives(spark, folder).mapInPandas(cut, f"{as_text}, payload binary")
    here = (F.col("place") == F.col("at_place")) & (F.col("offset") == F.col("at_offset"))
    joined = records.join(revisits, here, "left").drop("at_place", "at_offset", "place", "offset")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def fresh() -> Iterator[bytes]:
            for batch in batches:
                for r in batch.itertuples(index=False):
                    page, url = _whole(_text(r.page_id)), _text(r.url)
                    original, own = _text(r.original), fresh_id(r.record_id)
                    if original is None and r.record_type == "response":
                        yield record("response", own, page, url, r.payload_bytes, r.payload_digest, r.payload, {})
                        continue
                    refers = {
                        "WARC-Profile": PROFILE,
                        "WARC-Refers-To": _text(r.refers_record) if original is None else fresh_id(original),
                        "WARC-Refers-To-Target-URI": _text(r.original_url),
                        "WARC-Refers-To-Date": DATE,
                        "X-Refers-To-Page-Id": _text(r.refers_to if original is None else r.original_page),
                    }
                    yield record("revisit", own, page, url, r.payload_bytes, r.payload_digest, b"", refers)

        yield from _blocks(fresh(), archive_bytes)

    return _write(joined.mapInPandas(make, "block binary"), into)


def deduplicated_pages(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` as archives, resolve revisits, and return the headers of the new archives."""
    spark = pages.sparkSession
    raw = write_archives(pages, own_path(spark, "warc"), **columns)
    return read_headers(spark, resolve_revisits(spark, raw, own_path(spark, "warc-deduplicated")))
