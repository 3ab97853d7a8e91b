from __future__ import annotations

from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import warc
from tidemark.sources.shared import own_path

NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
TRICKY = "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n"
PAGES = [
    (1, "http://a/", "x"),
    (2, "http://b/\r\nX-Page-Id: 9", "x"),
    (2, "http://b/\r\nX-Page-Id: 9", "x"),
    (3, None, None),
    (None, "u", ""),
    (4, "é ü", TRICKY),
    (5, "z", TRICKY),
    (0, "q", "x"),
    (None, "w", "only without id"),
    (None, "w", "only without id"),
]
SCHEMA = "page_id long, url string, html string"


def test_revisits_as_brute_force(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("place", F.lit(1)).withColumn("block", F.lit("b"))
    assert brute.rows(warc.deduplicated_pages(pages), *NAMES) == brute.revisits(PAGES)


def test_hot_payload_and_long_page(spark):
    pages = [(i, "http://h/", "same" if i % 3 else f"own {i}") for i in range(300)] + [(999, "l", "é" * 300_000)]
    df = spark.createDataFrame(pages, SCHEMA)
    assert brute.rows(warc.deduplicated_pages(df), *NAMES) == brute.revisits(pages)


def test_empty_table(spark):
    assert warc.deduplicated_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_payloads_are_no_revisits_below_the_bound(spark):
    raw = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), own_path(spark, "raw"))
    found = warc.read_headers(spark, warc.resolve_revisits(spark, raw, own_path(spark, "new"), least_bytes=10))
    assert {r.payload_bytes > 1 for r in found.where("record_type = 'revisit'").collect()} == {True}


def test_archives_are_parted_and_headers_fresh(spark):
    pages = spark.createDataFrame([(i, "http://h/", "text " * 200) for i in range(20)], SCHEMA)
    raw = warc.write_archives(pages, own_path(spark, "raw"), archive_bytes=3000)
    assert spark.read.format("binaryFile").load(raw).count() > 5
    new = warc.resolve_revisits(spark, raw, own_path(spark, "new"))
    before = {r.record_id for r in warc.read_headers(spark, raw).collect()}
    after = {r.record_id for r in warc.read_headers(spark, new).collect()}
    assert len(before) == len(after) == 20 and not before & after


def links(spark, folder):
    """Records by id, and of each revisit what it refers to."""
    found = warc.read_headers(spark, folder).collect()
    by_id = {r.record_id: r for r in found}
    assert len(by_id) == len(found)
    return by_id, [(r, r.refers_record) for r in found if r.record_type == "revisit"]


def test_every_link_leads_to_a_response_of_the_new_archives(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).coalesce(2)
    raw = warc.write_archives(pages, own_path(spark, "raw"))
    folder = raw
    for _ in range(3):  # revisits of the last round are in the next one's archives
        folder = warc.resolve_revisits(spark, folder, own_path(spark, "new"))
        by_id, revisits = links(spark, folder)
        assert len(by_id) == len(PAGES) and len(revisits) == 6
        for r, to in revisits:
            original = by_id[to]
            assert original.record_type == "response" and original.payload_digest == r.payload_digest
            assert original.page_id == r.refers_to
    again = warc.resolve_revisits(spark, raw, own_path(spark, "new"))
    once = warc.resolve_revisits(spark, warc.write_archives(pages, own_path(spark, "raw")), own_path(spark, "new"))
    assert links(spark, again)[0].keys() == links(spark, once)[0].keys()


def test_archives_of_two_crawls_and_a_revisit_without_its_response(spark):
    first = warc.resolve_revisits(spark, warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), own_path(spark, "raw")), own_path(spark, "a"))
    only = own_path(spark, "only")
    kept = [r for f in spark.read.format("binaryFile").load(first).collect() for r in warc.parse(warc.gzip.decompress(f.content))]
    revisits = [r for r in kept if r.fields["warc-type"] == "revisit"]
    block = b"".join(
        warc.record(
            "revisit",
            r.fields["warc-record-id"],
            int(r.fields["x-page-id"]) if "x-page-id" in r.fields else None,
            None,
            int(r.http["content-length"]),
            r.fields["warc-payload-digest"].removeprefix("sha1:"),
            b"",
            {"WARC-Refers-To": r.fields["warc-refers-to"]},
        )
        for r in revisits
    )
    warc._write(spark.createDataFrame([(block[:-2],)], "block binary"), only)
    alone = links(spark, warc.resolve_revisits(spark, only, own_path(spark, "b")))
    assert {to for _, to in alone[1]} == {r.fields["warc-refers-to"] for r in revisits} and len(alone[0]) == len(revisits)
