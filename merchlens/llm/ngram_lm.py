"""Stupid-backoff scores of documents under the n-gram counts of all other documents.

Texts are dealt into buckets by a hash, compressed together for each bucket. Each bucket
explodes its texts into n-grams of one to three words, counts them, and sends one row of
packed (n-gram, count) pairs to every range of n-gram hashes. A range adds up the counts of
all buckets, which makes it one partition of the count table, and joins back to each
bucket's n-grams what the other buckets hold of them.
The bucket then scores its documents: every word by the longest n-gram ending in it that
other documents hold, and sums the logarithms per document.

An n-gram comes once from each bucket however often it is found, so no n-gram is too
frequent for one task; buckets and ranges grow with the bytes of text. N-grams are 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import WORD, documents, find_package
from merchlens.llm.packing import deltas, range_of, squeezed, unsqueezed
from merchlens.llm.shingles import WordHashes, grams, words_of

# Longest n-gram, and the factor for each order backed off.
ORDER, BACKOFF = 3, 0.4

# Buckets for each shuffle partition, more where a bucket would hold more bytes of text: a
# task holds its bucket's n-grams several times over.
BUCKETS_PER_PARTITION, BUCKET_BYTES = 2, 8_000_000
# Rows, and bytes of them, whose texts are compressed together by bucket.
DEALT_ROWS, DEALT_BYTES = 10_000, 32_000_000

_TEXTS = "bucket int, doc_ids array<bigint>, sizes array<int>, texts binary"
_COUNTS = "part int, bucket int, n int, hashes binary, counts binary"
_TOTALS = "bucket int, part int, n int, elsewhere binary"
_SCORES = (
    "doc_id bigint, n_words bigint, n_trigram bigint, n_bigram bigint, n_unigram bigint, "
    "log_counts double"
)


class _Bucket:
    """N-grams of a bucket's texts: words of all texts in one row, and their orders."""

    def __init__(self, texts: list[str | None]):
        hashes = WordHashes()
        words = [hashes.of(words_of(text)) for text in texts]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.owner = np.repeat(np.arange(len(words)), self.lengths)
        every = np.concatenate(words) if words else np.empty(0, np.uint64)
        begins = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(every)) - begins[self.owner]
        # grams[k][i]: the n-gram of k + 1 words that ends at word i, if it is in one text.
        self.inside = [self.place >= width for width in range(ORDER)]
        padded = [
            np.concatenate([np.zeros(min(width, len(every)), np.uint64), grams(every, width + 1)])
            for width in range(ORDER)
        ]
        found = [p[i] for p, i in zip(padded, self.inside)]
        self.distinct, at, self.counts = np.unique(
            np.concatenate(found), return_inverse=True, return_counts=True
        )
        cuts = np.cumsum([0, *map(len, found)])
        self.number = []
        for width in range(ORDER):
            number = np.full(len(every), -1, np.int64)
            number[self.inside[width]] = at[cuts[width] : cuts[width + 1]]
            self.number.append(number)

    def others(self, totals: np.ndarray, width: int) -> np.ndarray:
        """Count of the n-gram ending at each word in all other documents."""
        inside = self.inside[width]
        number, owner = self.number[width][inside], self.owner[inside]
        _, where, own = np.unique(
            owner * np.int64(len(self.distinct) + 1) + number,
            return_inverse=True,
            return_counts=True,
        )
        rest = np.zeros(len(inside), np.int64)
        rest[inside] = totals[number] - own[where]
        return rest

    def scores(self, totals: np.ndarray) -> list[np.ndarray]:
        """Per text: words, words scored by each order from the longest, sum of logs."""
        texts = len(self.lengths)
        held = [self.others(totals, width) for width in range(ORDER)]

        def before(counts: np.ndarray) -> np.ndarray:
            return np.concatenate([np.ones(min(1, len(counts)), np.int64), counts[:-1]])

        order = np.zeros(len(self.owner), np.int64)
        for width in range(1, ORDER):
            order[held[width] > 0] = width
        possible = np.minimum(self.place, ORDER - 1)
        logs = (possible - order) * np.log(BACKOFF)
        for width in range(ORDER):
            at = order == width
            logs[at] += np.log(np.maximum(held[width][at], 1))
            if width:
                logs[at] -= np.log(before(held[width - 1])[at])
        per_order = [
            np.bincount(self.owner[order == width], minlength=texts) for width in range(ORDER)
        ]
        return [
            self.lengths,
            *reversed(per_order),
            np.bincount(self.owner, weights=logs, minlength=texts),
        ]


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return pa.Table.from_arrays(columns, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a batch by bucket, those of a bucket in one row; a null text is an empty one."""
    schema, codec = _schema(_TEXTS), pa.Codec("zstd")
    for batch in _gathered(batches):
        bucket = batch["bucket"].to_numpy()
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        rows = []
        for start, end in zip(cuts[:-1], cuts[1:]):
            own = pa.array(order[start:end])
            texts = [(t or "").encode() for t in batch["text"].take(own).to_pylist()]
            rows.append(
                (
                    int(bucket[order[start]]),
                    batch["doc_id"].take(own).to_pylist(),
                    [len(text) for text in texts],
                    codec.compress(b"".join(texts), asbytes=True),
                )
            )
        yield from _table(schema, rows).to_batches()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to `DEALT_ROWS` rows or `DEALT_BYTES`."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
        if rows >= DEALT_ROWS or size >= DEALT_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _texts(table: pa.Table) -> tuple[list[int | None], list[str]]:
    """doc_ids and texts of a bucket."""
    doc_ids, texts, codec = [], [], pa.Codec("zstd")
    for row in table.select(["doc_ids", "sizes", "texts"]).to_pylist():
        cuts = np.cumsum([0, *row["sizes"]])
        data = codec.decompress(row["texts"], int(cuts[-1]), asbytes=True)
        doc_ids += row["doc_ids"]
        texts += [data[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])]
    return doc_ids, texts


def _count(parts: int):
    """Distinct n-grams of a bucket with their counts, a row per range of hashes."""

    def run(table: pa.Table) -> pa.Table:
        held = _Bucket(_texts(table)[1])
        part = range_of(held.distinct, parts)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        bucket = table["bucket"][0].as_py()
        rows = [
            (
                int(part[a]),
                bucket,
                int(b - a),
                squeezed(deltas(held.distinct[a:b])),
                squeezed(held.counts[a:b] - 1),
            )
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
        return _table(_schema(_COUNTS), rows)

    return run


def _total(table: pa.Table) -> pa.Table:
    """A range's count table, joined back: each bucket's n-grams, in order, in other buckets."""
    rows = table.to_pylist()
    hashes = [np.cumsum(unsqueezed(r["hashes"], r["n"]), dtype=np.uint64) for r in rows]
    counts = [unsqueezed(r["counts"], r["n"]) + np.uint64(1) for r in rows]
    _, at = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate(counts).astype(np.float64)).astype(np.uint64)
    cuts = np.cumsum([0, *map(len, hashes)])
    made = [
        (r["bucket"], r["part"], r["n"], squeezed(totals[at[a:b]] - own))
        for r, own, a, b in zip(rows, counts, cuts[:-1], cuts[1:])
    ]
    return _table(_schema(_TOTALS), made)


def _score(texts: pa.Table, elsewhere: pa.Table) -> pa.Table:
    """Scores of a bucket's documents from its n-grams and the other buckets' counts of them."""
    doc_ids, own = _texts(texts)
    held = _Bucket(own)
    rows = sorted(elsewhere.to_pylist(), key=lambda r: r["part"])
    counts = [unsqueezed(r["elsewhere"], r["n"]) for r in rows]
    every = np.concatenate(counts).astype(np.int64) if counts else np.empty(0, np.int64)
    words, trigrams, bigrams, unigrams, logs = held.scores(every + held.counts)
    return pa.table(
        {
            "doc_id": pa.array(doc_ids, pa.int64()),
            "n_words": pa.array(words, pa.int64()),
            "n_trigram": pa.array(trigrams, pa.int64()),
            "n_bigram": pa.array(bigrams, pa.int64()),
            "n_unigram": pa.array(unigrams, pa.int64()),
            "log_counts": pa.array(logs, pa.float64()),
        }
    )


def backoff_scores(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, words scored by each order, log_score and mean_log_score.

    A word is scored by the longest n-gram (of three, two, one words) that ends in it,
    lies in the document and is found in another document: its count there over that of
    its words but the last, or over all other documents' words for a single word. Each
    order given up costs a factor of 0.4; a word no other document holds counts as found
    once. `log_score` is the sum of natural logarithms and `mean_log_score` its mean per
    word, both to six decimals. Words are white-space separated, A-Z lower-cased.

    One row per row of `docs`, each scored as if it alone were left out; repeated rows
    see each other. A null or empty text has no words, a log_score of 0 and a null mean.
    Other columns are ignored; an empty table gives no rows.

    Texts and n-grams are dealt into `buckets`, by default two for each shuffle partition,
    and more where a bucket would hold over `BUCKET_BYTES` of text. A job counts words and
    bytes while the frame is built.
    """
    spark = docs.sparkSession
    find_package(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    sizes = docs.where("text IS NOT NULL").agg(F.sum(words), F.sum(F.octet_length("text"))).first()
    all_words, size = (value or 0 for value in sizes)
    buckets = buckets or max(BUCKETS_PER_PARTITION * partitions, -(-size // BUCKET_BYTES))
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    chosen = docs.select(spread.alias("bucket"), F.col("doc_id").cast("bigint"), "text")
    dealt = chosen.mapInArrow(_dealt, _TEXTS).repartition(
        max(partitions, -(-buckets // BUCKETS_PER_PARTITION)), "bucket"
    )
    counts = dealt.groupBy("bucket").applyInArrow(_count(buckets), _COUNTS)
    totals = counts.groupBy("part").applyInArrow(_total, _TOTALS)
    scored = (
        dealt.groupBy("bucket")
        .cogroup(totals.groupBy("bucket"))
        .applyInArrow(_score, _SCORES)
    )
    rest = F.greatest(F.lit(all_words) - F.col("n_words"), F.lit(1))
    score = F.col("log_counts") - F.col("n_unigram") * F.log(rest.cast("double"))
    return scored.withColumn("log_score", score).select(
        "doc_id",
        "n_words",
        "n_trigram",
        "n_bigram",
        "n_unigram",
        F.round("log_score", 6).alias("log_score"),
        F.when(
            F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6)
        ).alias("mean_log_score"),
    )


def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave-one-out trigram scores of all documents."""
    return backoff_scores(documents(spark, sf_dir))


ORACLE = r"""
    WITH texts AS (
      SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), words AS (
      SELECT d, unnest(range(1, len(w) + 1)) AS i, w FROM texts
    ), grams AS (
      SELECT d, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i-1] || ' ' || w[i] END AS g2,
        CASE WHEN i > 2 THEN w[i-2] || ' ' || w[i-1] || ' ' || w[i] END AS g3 FROM words
    ), held AS (
      SELECT *,
        count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY d, g1) AS c1,
        CASE WHEN g2 IS NULL THEN 0 ELSE
          count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY d, g2) END AS c2,
        CASE WHEN g3 IS NULL THEN 0 ELSE
          count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY d, g3) END AS c3
      FROM grams
    ), linked AS (
      SELECT *, lag(c1) OVER (PARTITION BY d ORDER BY i) AS b1,
        lag(c2) OVER (PARTITION BY d ORDER BY i) AS b2 FROM held
    ), scored AS (
      SELECT d, count(*) FILTER (c3 > 0) AS n_trigram,
        count(*) FILTER (c3 = 0 AND c2 > 0) AS n_bigram,
        count(*) FILTER (c3 = 0 AND c2 = 0) AS n_unigram,
        sum(CASE WHEN c3 > 0 THEN ln(c3) - ln(b2)
          WHEN c2 > 0 THEN ln(c2) - ln(b1) + (least(i, 3) - 2) * ln(0.4::DOUBLE)
          ELSE ln(greatest(c1, 1)) + (least(i, 3) - 1) * ln(0.4::DOUBLE) END) AS logs
      FROM linked GROUP BY d
    ), named AS (
      SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_trigram, 0) AS n_trigram,
        coalesce(n_bigram, 0) AS n_bigram, coalesce(n_unigram, 0) AS n_unigram,
        coalesce(logs, 0) - coalesce(n_unigram, 0)
          * ln(greatest((SELECT sum(len(w)) FROM texts) - len(w), 1)::DOUBLE) AS s
      FROM texts LEFT JOIN scored USING (d)
    )
    SELECT doc_id, n_words, n_trigram, n_bigram, n_unigram, round(s, 6) AS log_score,
      CASE WHEN n_words > 0 THEN round(s / n_words, 6) END AS mean_log_score FROM named"""
