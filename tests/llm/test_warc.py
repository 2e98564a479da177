from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from merchlens.llm import warc
from tests.comparison import as_bag
from tests.llm import corpus

SCHEMA = "page_id bigint, url string, html string"


def rows() -> list[tuple]:
    big, other = "<p>" + corpus.prose(1, 300), "<p>é" + corpus.prose(2, 300) + "\r\n\r\nWARC/1.1\r\n"
    return [
        (1, "http://a/1", big),
        (9, "http://a/9", big),
        (4, None, big),
        (5, "http://a/ with\nbreak", other),
        (6, "", "short"),
        (7, "http://a/7", "short"),
        (8, None, None),
        (10, "http://a/10", ""),
        (11, "http://a/11", "x" * 999),
        (12, "http://a/12", "x" * 999),
        (13, "http://a/13", "y" * 1000),
        (14, "http://a/14", "y" * 1000),
        (9, "http://a/9", big),
        (None, "http://none", "z" * 2000),
    ]


def expected(given: list[tuple]) -> Counter:
    owner = {}
    for page, _, html in given:
        if page is not None:
            owner[html or ""] = max(page, owner.get(html or "", page))
    found = Counter()
    for page, _, html in given:
        body = (html or "").encode()
        top = owner.get(html or "")
        revisit = len(body) >= 1000 and page != top
        kind = ("revisit", top) if revisit else ("response", None)
        found[(page, len(body), hashlib.sha1(body).hexdigest(), *kind)] += 1
    return found


@pytest.fixture
def archive(spark, tmp_path):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    warc.write_archive(corpus.clashing(pages), f"{tmp_path}/archive")
    return f"{tmp_path}/archive"


def test_records_come_back(spark, archive):
    got = warc.read_archive(spark, archive).collect()
    assert Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got
    ) == expected(rows())
    assert Counter((r.page_id, bytes(r.payload)) for r in got) == Counter(
        (page, (html or "").encode()) for page, _, html in rows()
    )
    for r in got:
        head = bytes(r.header)
        assert head.startswith(b"WARC/1.1\r\n") and head.endswith(b"\r\n\r\n")
        length = 0 if r.record_type == "revisit" else r.payload_bytes
        assert f"Content-Length: {length}\r\n".encode() in head


def test_payloads_are_stored_once(spark, archive):
    stored = spark.read.parquet(f"{archive}/payloads")
    assert stored.count() == len({html or "" for _, _, html in rows()})


def test_warc_files_round_trip(spark, archive, tmp_path):
    records = warc.read_archive(spark, archive)
    warc.write_warc(records, f"{tmp_path}/files", records_per_file=2)
    got = warc.read_warc(spark, f"{tmp_path}/files").collect()
    wanted = Counter(
        (bytes(r.header), bytes(r.payload) if r.record_type == "response" else b"")
        for r in records.collect()
    )
    assert Counter((bytes(r.header), bytes(r.block)) for r in got) == wanted


def test_a_damaged_payload_is_noticed(spark, archive, tmp_path):
    from pyspark.sql import functions as F

    stored = spark.read.parquet(f"{archive}/payloads")
    other = stored.where("payload_bytes = 1000").first().packed
    damaged = stored.withColumn(
        "packed", F.when(F.col("payload_bytes") == 999, F.lit(bytes(other))).otherwise(F.col("packed"))
    )
    damaged.write.parquet(f"{tmp_path}/bad/payloads")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{tmp_path}/bad/headers")
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.read_archive(spark, f"{tmp_path}/bad").collect()


def test_no_pages(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none")
    assert warc.read_archive(spark, f"{tmp_path}/none").collect() == []


def test_oracle_has_the_same_rows(spark):
    import duckdb

    pages = spark.createDataFrame(rows(), SCHEMA).toPandas()  # noqa: F841
    relation = duckdb.sql(warc.ORACLE)
    names, got = as_bag(relation.columns, relation.fetchall())
    wanted = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert (names, got) == as_bag(wanted, expected(rows()).elements())
