"""A content-addressed WARC archive.

A record is header lines and a payload. The archive keeps the exact header bytes of
every record in one table and every distinct payload once, compressed, in another,
under its SHA-256 digest; records are put together again by joining the two. Among
records with the same payload of at least `SHARED_BYTES` one is the response and the
others are revisits that refer to it.

Payloads are compressed in the task that first reads them, so what is shuffled and
stored is small. Digests are verified when payloads are stored (equal digests must
have equal lengths and equal SHA-1) and again from the restored bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import find_package, per_batch
from merchlens.session import new_shared_folder

# Fixed value: shorter payloads are stored once too, but no record revisits another's.
SHARED_BYTES = 1000

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Written into every record, so that archives of the same pages are the same.
RECORD_DATE = "2024-01-01T00:00:00Z"

_FIELD = re.compile(rb"^([A-Za-z-]+): (.*)\r$", re.MULTILINE)


def _payload(html: str | None) -> bytes:
    return (html or "").encode("utf-8", "surrogatepass")


def stored_payloads(pages: DataFrame) -> DataFrame:
    """One row per distinct payload: digests, length, largest page_id, compressed bytes.

    Copies are combined in the tasks that read them, before anything is shuffled.
    """

    def step(page_id, pages_html):
        pack = zstandard.ZstdCompressor(level=3).compress
        bodies = [_payload(html) for html in pages_html]
        return [
            [hashlib.sha256(body).digest() for body in bodies],
            page_id,
            [hashlib.sha1(body).hexdigest() for body in bodies],
            [len(body) for body in bodies],
            [pack(body) for body in bodies],
        ]

    schema = "sha256 binary, page_id bigint, sha1 string, payload_bytes bigint, packed binary"
    rows = per_batch(pages, ["page_id", "html"], step, schema)
    same = (F.min("sha1") == F.max("sha1")) & (F.min("payload_bytes") == F.max("payload_bytes"))
    verified = F.when(same, F.min("sha1")).otherwise(
        F.raise_error(F.lit("different payloads share a SHA-256 digest"))
    )
    return rows.groupBy("sha256").agg(
        verified.alias("sha1"),
        F.max("payload_bytes").alias("payload_bytes"),
        F.max("page_id").alias("owner"),
        F.any_value("packed").alias("packed"),
    )


def record_headers(pages: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id, the exact header bytes of its record, and the digest of its payload.

    A record is a revisit when its payload has at least `SHARED_BYTES` and a larger
    page_id holds it. Rows equal in page_id and payload are the same record; a null
    page_id is smaller than any other.
    """

    def step(page_id, urls, pages_html):
        return [page_id, urls, [hashlib.sha256(_payload(html)).digest() for html in pages_html]]

    rows = per_batch(
        pages, ["page_id", "url", "html"], step, "page_id bigint, url string, sha256 binary"
    )
    joined = rows.join(payloads.drop("packed"), "sha256")
    revisit = (F.col("payload_bytes") >= SHARED_BYTES) & ~F.col("page_id").eqNullSafe(
        F.col("owner")
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    uri = F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), page)), r"\s", "%20")

    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        line("WARC-Target-URI", uri),
        line("WARC-Date", F.lit(RECORD_DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        F.when(
            revisit,
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), "owner", F.lit(">"))),
        ),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))),
        F.lit("\r\n"),
    )
    return joined.select("page_id", header.cast("binary").alias("header"), "sha256")


def write_archive(pages: DataFrame, folder: str) -> None:
    """Store payloads and then headers below `folder`, both as Parquet.

    `pages` has page_id, url and html; null html is an empty payload, a null url is
    replaced by the page's own name, other columns are ignored. No pages give two
    empty tables.
    """
    spark = pages.sparkSession
    stored_payloads(pages).write.parquet(f"{folder}/payloads")
    payloads = spark.read.parquet(f"{folder}/payloads")
    record_headers(pages, payloads).write.parquet(f"{folder}/headers")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records of an archive: page_id, header, payload, and what the header says.

    The payload is that of the record itself or, for a revisit, of the response it
    refers to. Its bytes are checked against the key they were stored under and the
    digest in the header.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").select("sha256", "packed")

    def step(page_id, header, sha256, packed):
        unpack = zstandard.ZstdDecompressor().decompress
        kinds, refers, digests, sizes, bodies = [], [], [], [], []
        for head, key, held in zip(header, sha256, packed):
            fields = dict(_FIELD.findall(head))
            body = unpack(held)
            sha1 = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
            if hashlib.sha256(body).digest() != key or hashlib.sha1(body).hexdigest() != sha1:
                raise ValueError(f"payload does not fit its digest {sha1}")
            target = fields.get(b"WARC-Refers-To")
            kinds.append(fields[b"WARC-Type"].decode())
            refers.append(int(target[len(b"<urn:page:") : -1]) if target else None)
            digests.append(sha1)
            sizes.append(len(body))
            bodies.append(body)
        return [page_id, header, bodies, sizes, digests, kinds, refers]

    return per_batch(
        headers.join(payloads, "sha256"),
        ["page_id", "header", "sha256", "packed"],
        step,
        "page_id bigint, header binary, payload binary, payload_bytes bigint, "
        "payload_digest string, record_type string, refers_to bigint",
    )


def write_warc(archive: DataFrame, folder: str, records_per_file: int = 1000) -> None:
    """Write the records of `read_archive` as gzipped WARC files.

    A revisit has no block. Records end with two line breaks, which Spark's text writer
    puts after every row; a file holds at most `records_per_file` records.
    """
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat("header", block).cast("string").alias("value")
    options = {
        "lineSep": "\r\n\r\n",
        "compression": "gzip",
        "maxRecordsPerFile": records_per_file,
    }
    archive.select(record).write.options(**options).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """header and block of every record in the gzipped WARC files of a folder.

    Records are cut by their Content-Length, so blocks may hold any bytes. A task holds
    one file at a time.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, at, headers, blocks = gzip.decompress(content.as_py()), 0, [], []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    size = int(dict(_FIELD.findall(data[at:end]))[b"Content-Length"])
                    headers.append(data[at:end])
                    blocks.append(data[end : end + size])
                    at = end + size + 4
                columns = [pa.array(headers, pa.binary()), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(records, "header binary, block binary")


def op5_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to an archive in the shared folder and read back from it."""
    find_package(spark)
    folder = new_shared_folder(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archive(spark, folder).drop("header", "payload")


ORACLE = f"""
    WITH held AS (
      SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
    ), sized AS (
      SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
        max(page_id) OVER (PARTITION BY body) AS owner FROM held
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= {SHARED_BYTES} AND page_id IS DISTINCT FROM owner
        THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= {SHARED_BYTES} AND page_id IS DISTINCT FROM owner
        THEN owner END AS refers_to
    FROM sized"""
