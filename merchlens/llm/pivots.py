"""Exact top-k search by inner product with a pivot table.

A vector gets one more component, so that all are equally long; then the nearest vectors
by distance are those with the highest scores, and a query, which gets a zero there, has
score (|q|^2 + M - d^2) / 2 with a vector at distance d, M being the largest squared
length. The distance of every vector to every pivot is computed once and kept beside it.
By the triangle inequality no vector is nearer to a query than the difference of their
distances to a pivot, and the largest difference over all pivots bounds best. A query
takes candidates in the order of these bounds, and stops where the next bound leaves no
score as high as its k-th.

Vectors are kept in blocks by their nearest pivot. A query is first answered within its
own block, which gives it a score to beat; it goes on to those blocks only whose ranges of
pivot distances leave room for that score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm import vectors as v

PIVOTS = 32
SCALE, QUERY_EVERY, TOP = 64, 20, 20

# Distances are kept as 32-bit floats; this part of the longest covers their rounding.
_SLACK = 1e-6
# Candidates that a query evaluates before it looks at its bounds again.
_STEP = 256
_NONE = -(1 << 63)


class PivotTable:
    """Pivots, and distances and bounds in the space where all vectors are equally long."""

    def __init__(self, vectors: np.ndarray, norms: np.ndarray, longest: int):
        """Pivots far from each other: each the farthest of the sample from those before."""
        self.longest = float(longest)
        self.slack = _SLACK * max(1.0, 2 * self.longest) ** 0.5
        lifted = self._lifted(vectors, norms)
        chosen, nearest = [], np.full(len(lifted), np.inf)
        for _ in range(min(PIVOTS, len(lifted))):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
        self.pivots = lifted[chosen]

    def _lifted(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - norms.astype(float), 0))
        return np.column_stack([vectors.astype(float), rest])

    def _to_pivots(self, lifted: np.ndarray) -> np.ndarray:
        square = (
            (lifted**2).sum(axis=1)[:, None]
            + (self.pivots**2).sum(axis=1)
            - 2 * (lifted @ self.pivots.T)
        )
        return np.sqrt(np.maximum(square, 0)).astype(np.float32)

    def of_vectors(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return self._to_pivots(self._lifted(vectors, norms))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return self._to_pivots(np.column_stack([vectors.astype(float), np.zeros(len(vectors))]))

    def most(self, norm2: float, bound: np.ndarray) -> np.ndarray:
        """Highest score that a distance bound leaves to a query."""
        least = np.maximum(bound - 2 * self.slack, 0) ** 2
        whole = norm2 + self.longest
        return (whole - least) / 2 + 1e-9 * whole + 0.5


class Block:
    """A packed block opened for search."""

    def __init__(self, row: dict, width: int):
        n = row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], np.bool_)
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.norms = np.frombuffer(row["norms"], np.int64)
        self.whole = np.frombuffer(row["x"], np.int32).reshape(n, width)
        self.vectors = v.exact(self.whole, self.norms)
        self.distances = np.ascontiguousarray(
            np.frombuffer(row["distances"], np.float32).reshape(n, -1).T
        )

    def best(
        self,
        table: PivotTable,
        query: np.ndarray,
        to_pivots: np.ndarray,
        own: int,
        k: int,
        least: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best from `least` on, the row `own` left out."""
        bound = np.zeros(len(self.ids), np.float32)
        for at, distance in enumerate(to_pivots):
            np.maximum(bound, np.abs(self.distances[at] - distance), out=bound)
        norm2 = float(query.astype(float) @ query)
        open_ = np.flatnonzero((table.most(norm2, bound) >= least) & (self.rows != own))
        order = open_[np.argsort(bound[open_], kind="stable")]
        most = table.most(norm2, bound[order])
        places, found, at = np.empty(0, np.int64), np.empty(0, np.int64), 0
        # Bounds only rise, so nothing after a bound below the k-th score can be as high.
        while at < len(order) and most[at] >= least:
            taken = order[at : at + _STEP]
            reached = v.scores(self.vectors[taken], query)
            high = reached >= least
            places = np.concatenate([places, taken[high]])
            found = np.concatenate([found, reached[high]])
            if len(found) > k:
                kept = np.lexsort((~self.known[places], self.ids[places], -found))[:k]
                places, found = places[kept], found[kept]
            if len(found) == k:
                least = max(least, int(found.min()))
            at += _STEP
        return places, found


_PACKED = (
    "n int, ids binary, known binary, rows binary, norms binary, x binary, distances binary, "
    "lows binary, highs binary"
)
_HITS = "row bigint, query_id bigint, vec_id bigint, score bigint"
_SENT = (
    "row bigint, query_id bigint, x binary, to_pivots binary, least bigint, blocks array<bigint>"
)
_QUERIES = (
    "row bigint, query_id bigint, home bigint, x binary, to_pivots binary, least bigint, "
    "found array<struct<vec_id:bigint,score:bigint>>"
)


def _packer(table: PivotTable, width: int):
    def pack(rows: pa.Table) -> dict:
        ids, known = v.ids_of(rows["vec_id"].combine_chunks())
        norms = rows["norm2"].to_numpy()
        whole = v.matrix(rows["x"], width)
        distances = table.of_vectors(whole, norms)
        return {
            "n": len(ids),
            "ids": ids.tobytes(),
            "known": known.tobytes(),
            "rows": rows["row"].to_numpy().tobytes(),
            "norms": norms.tobytes(),
            "x": whole.tobytes(),
            "distances": distances.tobytes(),
            "lows": distances.min(axis=0).tobytes(),
            "highs": distances.max(axis=0).tobytes(),
        }

    return pack


def _at_home(table: PivotTable, width: int, every: int, k: int):
    """The queries of each block, with the best of their own block."""
    kinds = v.arrow_schema(_QUERIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block, made = Block(row, width), []
                for q in np.flatnonzero(block.known & (block.ids % every == 0)):
                    query = block.whole[q]
                    to_pivots = table.of_queries(query[None])[0]
                    places, found = block.best(table, query, to_pivots, block.rows[q], k, _NONE)
                    least = int(found.min()) if len(found) == k else _NONE
                    hits = [
                        {"vec_id": int(i) if known else None, "score": int(s)}
                        for i, known, s in zip(block.ids[places], block.known[places], found)
                    ]
                    made.append(
                        (int(block.rows[q]), int(block.ids[q]), row["block"], query.tobytes())
                        + (to_pivots.tobytes(), least, hits)
                    )
                if made:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*made), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return run


def _elsewhere(table: PivotTable, names: np.ndarray, lows: np.ndarray, highs: np.ndarray):
    """The other blocks that may hold something as good as a query's k-th."""
    schema = v.arrow_schema(_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for query in batch.select(["home", "x", "to_pivots", "least"]).to_pylist():
                to_pivots = np.frombuffer(query["to_pivots"], np.float32)
                bound = np.maximum(lows - to_pivots, to_pivots - highs).max(axis=1, initial=0)
                whole = np.frombuffer(query["x"], np.int32).astype(float)
                room = table.most(float(whole @ whole), bound) >= query["least"]
                kept.append(names[room & (names != query["home"])])
            columns = [batch.column(n) for n in schema.names[:-1]] + [pa.array(kept, schema[-1].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _compared(table: PivotTable, width: int, k: int):
    schema = v.arrow_schema(_HITS)

    def compare(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        parts = []
        for packed in blocks.to_pylist():
            block = Block(packed, width)
            for query in queries.to_pylist():
                places, found = block.best(
                    table,
                    np.frombuffer(query["x"], np.int32),
                    np.frombuffer(query["to_pivots"], np.float32),
                    query["row"],
                    k,
                    query["least"],
                )
                columns = [
                    pa.array(np.full(len(found), query["row"])),
                    pa.array(np.full(len(found), query["query_id"])),
                    v.nullable(block.ids[places], block.known[places]),
                    pa.array(found),
                ]
                parts.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(parts, schema=schema)

    return compare


def top_scores(
    table: DataFrame,
    every: int = QUERY_EVERY,
    k: int = TOP,
    scale: int = SCALE,
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every query.

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by
    `every`; candidates are all other rows. Ties go to the smaller vec_id. A null vector,
    or one with a null or non-finite component, takes no part, nor does one of a squared
    integer length from 2^61. Shorter vectors count as filled up with zeros. A row with a
    null vec_id is a candidate, the last among ties, and never a query. Repeated rows are
    rows of their own: each is a candidate for the other, and each repeated query has an
    answer. An empty table gives no rows. Further columns are ignored.

    PIVOTS pivots are chosen among at most SAMPLE_ROWS rows; the result does not depend
    on them. The pivot table and the bounds of at most MOST_BLOCKS blocks travel with
    tasks. Runs jobs while it is built: vectors, blocks and queries are checkpointed.
    """
    vectors = v.integer_vectors(table, scale, vector, "vec_id")
    asking = F.count_if(F.col("vec_id") % every == 0)
    facts = vectors.agg(F.count(F.lit(1)), F.max("norm2"), F.max(F.octet_length("x")), asking)
    rows, longest, size, queries = facts.first()
    width = (size or 0) // 4
    held = v.sample(vectors)
    pivots = PivotTable(v.matrix(held["x"], width), held["norm2"].to_numpy(), longest or 0)
    nearest = _nearest_pivot(vectors, pivots, width)
    blocks = v.in_blocks(
        nearest, rows, ["cell", "vec_id", "row"], _packer(pivots, width), _PACKED
    )
    asked = blocks.mapInArrow(_at_home(pivots, width, every, k), _QUERIES).checkpoint()
    bounds = blocks.select("block", "lows", "highs").toArrow()
    lows, highs = (
        np.array([np.frombuffer(b, np.float32) for b in bounds[name].to_pylist()]).reshape(
            bounds.num_rows, len(pivots.pivots)
        )
        for name in ("lows", "highs")
    )
    sent = asked.mapInArrow(
        _elsewhere(pivots, bounds["block"].to_numpy(), lows, highs),
        _SENT,
    ).withColumn("block", F.explode("blocks"))
    parts = -(-queries // v.QUERIES_PER_TASK) or 1
    away = v.beside_blocks(
        sent.drop("blocks"), blocks.drop("lows", "highs"), parts, _compared(pivots, width, k), _HITS
    )
    home = asked.select("row", "query_id", F.inline("found"))
    order = Window.partitionBy("row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    return (
        home.unionByName(away)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _nearest_pivot(vectors: DataFrame, pivots: PivotTable, width: int) -> DataFrame:
    """Vectors with `cell`, the number of their nearest pivot."""
    schema = "row bigint, vec_id bigint, norm2 bigint, x binary, cell int"
    arrow = v.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distances = pivots.of_vectors(
                v.matrix(batch.column("x"), width), batch.column("norm2").to_numpy()
            )
            cell = pa.array(distances.argmin(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], schema=arrow)

    return vectors.select("row", "vec_id", "norm2", "x").mapInArrow(run, schema)


def op13_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every embedding whose vec_id is divisible by 20."""
    return top_scores(v.embeddings(spark, sf_dir))


ORACLE = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v,
    row_number() OVER () AS row
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % {QUERY_EVERY} = 0 AND c.row <> q.row
)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score
FROM scored QUALIFY rank <= {TOP}"""
