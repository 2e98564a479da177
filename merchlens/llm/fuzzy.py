"""Context-triggered piecewise hashes of whole texts, compared by edit distance.

A rolling hash over the last seven bytes cuts a text wherever its value plus one is a
multiple of the block size, so cuts depend on nearby bytes alone and survive edits
elsewhere. Each piece gives one signature character. A fingerprint holds the block
size, the signature at it, and the shorter one at twice the size. Block sizes are
three times a power of two, so one pass finds the cuts of all sizes.

Documents and their successors are brought together by ranges of doc_id: texts are
shuffled once, and the first document of each range is also sent to the range before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import documents, per_batch, slices

# Bytes the rolling hash sees, smallest block size, signature lengths.
WINDOW, SMALLEST, LONG, SHORT = 7, 3, 64, 32

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_CHUNK = 1 << 20
_NO_CUT = -1


def cut_levels(data: bytes, before: bytes = b"") -> np.ndarray:
    """Per byte, the largest k such that it ends a piece at block size 3 * 2^k, or -1.

    `before` are the bytes ahead of `data`; only the last six matter.
    """
    ahead = (bytes(WINDOW - 1) + before)[-(WINDOW - 1) :]
    levels = np.empty(len(data), np.int8)
    for start in range(0, len(data), _CHUNK):
        part = data[start : start + _CHUNK]
        window = np.frombuffer(ahead + part, np.uint8).astype(np.uint32)
        ahead = (ahead + part)[-(WINDOW - 1) :]
        size = len(part)
        total = np.zeros(size, np.uint32)
        spread = np.zeros(size, np.uint32)
        for back in range(WINDOW):
            byte = window[WINDOW - 1 - back : WINDOW - 1 - back + size]
            total += byte * np.uint32(WINDOW + 1 - back)
            spread ^= byte << np.uint32(5 * back % 32)
        value = (total + spread).astype(np.uint64) + np.uint64(1)
        lowest = value & (~value + np.uint64(1))
        power = np.log2(lowest.astype(np.float64)).astype(np.int8)
        levels[start : start + size] = np.where(value % np.uint64(SMALLEST) == 0, power, _NO_CUT)
    return levels


def _signature(data: bytes, levels: np.ndarray, level: int, length: int) -> str:
    """One letter per piece; the last letter covers all that is left."""
    ends = np.flatnonzero(levels >= level)[: length - 1] + 1
    letters, start = [], 0
    for end in [*ends.tolist(), len(data)]:
        if end > start:
            letters.append(_LETTERS[xxhash.xxh32_intdigest(data[start:end]) & 63])
        start = end
    return "".join(letters)


def fingerprint(data: bytes, levels: np.ndarray | None = None) -> str:
    """`size:signature:signature` of a text's bytes; equal texts have equal ones.

    The block size is the smallest that allows for the length with 64 pieces, halved
    while there are fewer than 32.
    """
    if levels is None:
        levels = cut_levels(data)
    level = 0
    while (SMALLEST << level) * LONG < len(data):
        level += 1
    while level and np.count_nonzero(levels >= level) < SHORT:
        level -= 1
    return (
        f"{SMALLEST << level}:{_signature(data, levels, level, LONG)}"
        f":{_signature(data, levels, level + 1, SHORT)}"
    )


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time as bits."""
    places: dict[str, int] = {}
    for at, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << at
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        met = row & places.get(letter, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    """1 less the edit distance (insert, delete) over both lengths.

    0 unless the signatures share a run of letters, four for all but short ones; chance
    does not give unrelated texts such a run.
    """
    if not a or not b:
        return 0.0
    run = min(4, max(1, min(len(a), len(b)) // 4))
    if {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(
        b[i : i + run] for i in range(len(b) - run + 1)
    ):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(first: str, second: str) -> float:
    """Similarity of two fingerprints from 0 to 1; 0 if their block sizes are not compatible."""
    if first == second:
        return 1.0
    size_a, long_a, short_a = first.split(":")
    size_b, long_b, short_b = second.split(":")
    a, b = int(size_a), int(size_b)
    if a == b:
        return max(_alike(long_a, long_b), _alike(short_a, short_b))
    if a == 2 * b:
        return _alike(long_a, short_b)
    if b == 2 * a:
        return _alike(short_a, long_b)
    return 0.0


@dataclass
class _Document:
    bucket: int
    copy: bool
    doc_id: int | None
    text: str
    data: bytes
    levels: np.ndarray
    print: str

    def compared(self, following: _Document) -> tuple:
        """The result row of this document with the one after it."""
        size = len(self.text)
        half = size // 2
        head = self.text[: size - half].encode()
        tail = following.text[:half].encode()
        seam = min(WINDOW - 1, len(tail))
        levels = np.concatenate(
            [
                self.levels[: len(head)],
                cut_levels(tail[:seam], head),
                following.levels[seam : len(tail)],
            ]
        )
        edited = head + tail
        edited_print = fingerprint(edited, levels)
        return (
            self.doc_id,
            size,
            hashlib.sha256(edited).hexdigest(),
            self.print,
            edited_print,
            likeness(self.print, edited_print),
            likeness(self.print, following.print),
        )


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each range in order, then a copy of the first row of the next range."""
    last: _Document | None = None
    for batch in slices(batches):
        rows = []
        for bucket, copy, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            open_ = last is not None and last.bucket == bucket and not last.copy
            if copy and not open_:
                continue
            data = text.encode()
            levels = cut_levels(data)
            document = _Document(
                bucket, bool(copy), doc_id, text, data, levels, fingerprint(data, levels)
            )
            if open_:
                rows.append(last.compared(document))
            last = document
        if rows:
            columns = [pa.array(v, f.type) for v, f in zip(zip(*rows), _RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_RESULT)


def _ranges(docs: DataFrame, buckets: int) -> tuple[np.ndarray, dict[int, int]]:
    """Where ranges of doc_id begin, and the range before each range's first doc_id.

    One number per range comes to the driver, and only doc_id is read.
    """
    ids = docs.select(_placed_id().alias("placed"))
    probabilities = [i / buckets for i in range(1, buckets)]
    found = ids.approxQuantile("placed", probabilities, 1 / (4 * buckets)) if buckets > 1 else []
    starts = np.unique(np.array(found, dtype=np.float64))

    def place(column):
        return [np.searchsorted(starts, np.array(column, np.float64), side="right").tolist(), column]

    held = per_batch(ids, ["placed"], place, "bucket bigint, placed bigint")
    firsts = held.groupBy("bucket").agg(F.min("placed").alias("first")).orderBy("bucket").collect()
    return starts, {
        row.first: firsts[at - 1].bucket for at, row in enumerate(firsts)
    }


def _placed_id():
    """doc_id in its order, null before all others."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)))


def edited_likeness(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last floor(n_chars / 2) code points replaced by as many from
    the start of the next document (or all of it), in ascending order of doc_id, the first
    after the last. A null text counts as empty; a null doc_id comes first; documents with
    equal doc_id follow each other by text. A single document is its own successor; an
    empty table gives no rows. Other columns are ignored.

    `buckets` ranges are compared in parallel, by default as many as shuffle partitions;
    a task compares two documents at a time, whatever their range holds, and turns about
    4 MB of a batch into Python values at a time. Jobs find the ranges while the frame is
    built.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts, previous = _ranges(docs, buckets)

    def deal(placed, doc_id, texts):
        at = np.searchsorted(starts, np.array(placed, np.float64), side="right").tolist()
        copies = [i for i, p in enumerate(placed) if p in previous]
        return [
            at + [previous[placed[i]] for i in copies],
            [0] * len(at) + [1] * len(copies),
            placed + [placed[i] for i in copies],
            doc_id + [doc_id[i] for i in copies],
            texts + [texts[i] for i in copies],
        ]

    dealt = per_batch(
        docs.select(
            _placed_id().alias("placed"),
            "doc_id",
            F.coalesce("text", F.lit("")).alias("text"),
        ),
        ["placed", "doc_id", "text"],
        deal,
        "bucket bigint, copy int, placed bigint, doc_id bigint, text string",
    )
    ordered = dealt.repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "copy", "placed", "text"
    )
    return ordered.select("bucket", "copy", "doc_id", "text").mapInArrow(
        _compare,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op4_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of all documents."""
    return edited_likeness(documents(spark, sf_dir))
