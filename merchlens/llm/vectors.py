"""Integer vectors as rows, and as packed blocks that a task compares in one go."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from merchlens.llm.common import find_package
from merchlens.session import ensure_checkpoint_dir

# Rows of a block, more where there would be too many blocks; queries that a task
# holds beside one block; rows that models of the data are fitted on.
BLOCK_ROWS, MOST_BLOCKS = 16_384, 8_192
QUERIES_PER_TASK = 8_192
SAMPLE_ROWS = 4_096

# Scores of vectors below this squared length fit into a long.
_LONGEST = float(1 << 61)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string; for the driver only."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def integer_vectors(table: DataFrame, scale: int, vector: str, *kept: str) -> DataFrame:
    """row, the columns `kept`, norm2 and `x`: floor(scale * component) as packed int32.

    `row` tells rows apart. Rows whose vector is null or has a null or non-finite component
    are left out, and so are vectors of a squared length from 2^61, whose scores need not
    fit into a long. Checkpointed, so that later passes read small rows.
    """
    ensure_checkpoint_dir(table.sparkSession)
    find_package(table.sparkSession)
    rows = table.select(
        F.monotonically_increasing_id().alias("row"),
        *(F.col(name).cast("bigint").alias(name) for name in kept),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    names = ["row", *kept]
    schema = ", ".join(f"{name} bigint" for name in names) + ", norm2 bigint, x binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(len(names))
            made, chosen, norms = [], [], []
            for at, values in enumerate(vectors):
                if not values.is_valid:
                    continue
                found = np.floor(scale * values.values.to_numpy(zero_copy_only=False).astype(float))
                norm = float(found @ found)
                if norm < _LONGEST:  # not so if a component is null or not finite
                    whole = found.astype(np.int32)
                    made.append(whole.tobytes())
                    chosen.append(at)
                    norms.append(int(whole.astype(np.int64) @ whole.astype(np.int64)))
            columns = [batch.column(i).take(pa.array(chosen, pa.int64())) for i in range(len(names))]
            columns += [pa.array(norms, pa.int64()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, schema).checkpoint()


def matrix(column, width: int) -> np.ndarray:
    """Packed int32 vectors as rows of a matrix; shorter ones are filled up with zeros."""
    out = np.zeros((len(column), width), np.int32)
    for at, value in enumerate(column):
        own = np.frombuffer(value.as_buffer(), np.int32)
        out[at, : len(own)] = own
    return out


def exact(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """The matrix in the type that gives exact products: doubles as long as they can."""
    return vectors.astype(np.float64 if norms.max(initial=0) < 1 << 52 else np.int64)


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products of a matrix from `exact` with one int32 vector.

    Any partial sum is at most the product of both lengths, so doubles are exact while
    both squared lengths are below 2^52; a longer query goes through integers.
    """
    wide = query.astype(np.int64)
    if vectors.dtype == np.float64 and wide @ wide < 1 << 52:
        return (vectors @ wide.astype(np.float64)).astype(np.int64)
    return vectors.astype(np.int64) @ wide


def ids_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and where they are null; a null id stands last among equals."""
    known = np.array(column.is_valid())
    return column.fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False).astype(np.int64), known


def nullable(ids: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=~known)


def sample(rows: DataFrame) -> pa.Table:
    """At most SAMPLE_ROWS rows, those with the smallest hashes; they come to the driver."""
    chosen = rows.orderBy(F.xxhash64("x", "row"), "row").limit(SAMPLE_ROWS)
    return chosen.select("x", "norm2").toArrow()


def block_count(rows: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-rows // BLOCK_ROWS)))


def in_blocks(
    rows: DataFrame, total: int, order: list[str], pack: Callable[[pa.Table], dict], schema: str
) -> DataFrame:
    """One packed row per range of `order`, and `block`, its number; checkpointed.

    `pack` makes the columns of `schema` from a range's rows, `total` in all. `order` has to
    end in a column that tells rows apart, so that equal rows are cut as well. A range
    comes out up to about twice its share of rows; larger ones are cut.
    """
    arrow = arrow_schema(schema)

    def one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        made = pack(pa.Table.from_batches(batches))
        return pa.RecordBatch.from_arrays(
            [pa.array([made[f.name]], f.type) for f in arrow], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= 2 * most:
                yield one(held)
                held, n = [], 0
        if n:
            yield one(held)

    count = block_count(total)
    most = max(BLOCK_ROWS, -(-total // count))
    ranged = rows.repartitionByRange(count, *order)
    return (
        ranged.mapInArrow(run, schema)
        .withColumn("block", F.monotonically_increasing_id())
        .checkpoint()
    )


def beside_blocks(
    queries: DataFrame,
    blocks: DataFrame,
    parts: int,
    compare: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """What `compare` makes of each block and the queries sent to it, a part at a time.

    `queries` has `row` and `block`. Queries are dealt into parts, so that a task holds
    one block and at most about QUERIES_PER_TASK queries; a block goes to every part.
    """
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    spread = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    none = arrow_schema(schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return compare(left, right) if left.num_rows and right.num_rows else none

    keys = ["block", "part"]
    return dealt.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, schema)
