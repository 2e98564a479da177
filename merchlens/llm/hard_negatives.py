"""Hard-negative mining over an inverted multi-index.

Vectors are cut in halves, and each half has a codebook. A vector lies in the cell that
its two nearest codes name, and a block of vectors is kept cell by cell. No half within a
radius of its code scores more with a query's half than the code itself does plus query
length times radius; the sum of both half bounds is the bound of a cell. With codes of
both halves in the order of their bounds, a heap over pairs of codes visits cells by
falling bound, without a look at those it never gets to.

An anchor first takes its positives, the best rows of its own label, in its own block and
then in others that may hold better ones. Each positive opens a window of scores for
negatives, which are searched in the same two steps. A window is certified, and its search over, when the
bound of the next cell is below what is found already, or below the window itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm import vectors as v

SCALE, ANCHOR_EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 10
# A negative's score as parts of a hundred of the positive's.
LEAST_PART, MOST_PART = 30, 90

CODES, TRAININGS = 16, 10
# Rows of cells that are scored together.
_STEP = 512
_NONE = -(1 << 63)


def window(positive_score: int) -> tuple[int, int]:
    """Lowest and highest score of a negative; empty (low above high) below zero."""
    return -(-LEAST_PART * positive_score // 100), MOST_PART * positive_score // 100


class Codebooks:
    """A codebook per half of the vectors."""

    def __init__(self, vectors: np.ndarray):
        """Fit on a sample: far apart rows as first codes, then means of what is nearest."""
        self.cut = vectors.shape[1] // 2
        self.codes = [self._fit(half.astype(float)) for half in self.halves(vectors)]

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[..., : self.cut], vectors[..., self.cut :]

    @staticmethod
    def _fit(half: np.ndarray) -> np.ndarray:
        chosen, nearest = [], np.full(len(half), np.inf)
        for _ in range(min(CODES, len(half))):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((half - half[chosen[-1]]) ** 2).sum(axis=1))
        codes = half[chosen]
        if not chosen:
            return codes
        for _ in range(TRAININGS):
            own = _distances(half, codes).argmin(axis=1)
            held = np.bincount(own, minlength=len(codes))
            sums = np.zeros_like(codes)
            np.add.at(sums, own, half)
            codes = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], codes)
        return codes

    def places(self, vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per half: the nearest code of each vector, and the distance to it."""
        found = [_distances(h.astype(float), c) for h, c in zip(self.halves(vectors), self.codes)]
        return [d.argmin(axis=1) for d in found], [d.min(axis=1, initial=np.inf) for d in found]

    def bounds(self, query: np.ndarray, radii: list[np.ndarray]) -> list[np.ndarray]:
        """Per half: most that a half in each code scores; minus infinity in an unused code."""
        made = []
        for half, codes, radius in zip(self.halves(query.astype(float)), self.codes, radii):
            length = np.sqrt(half @ half)
            reach = codes @ half + length * radius
            slack = 1e-9 * (1 + np.abs(reach) + length * np.abs(radius))
            made.append(np.where(radius >= 0, reach + slack, -np.inf))
        return made


def _distances(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.sqrt(((half[:, None, :] - codes[None]) ** 2).sum(axis=2)) if half.size else np.zeros(
        (len(half), len(codes))
    )


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Pairs of codes by falling sum of their bounds, as (sum, left code, right code).

    A pair enters the heap only after both its neighbours with higher sums have left it.
    """
    rows, columns = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap, taken = [(-(left[rows[0]] + right[columns[0]]), 0, 0)], np.zeros(len(rows), int)
    while heap:
        total, i, j = heapq.heappop(heap)
        if total == np.inf:
            return
        yield -total, int(rows[i]), int(columns[j])
        taken[i] = j + 1
        if j + 1 < len(columns) and (i == 0 or taken[i - 1] > j + 1):
            heapq.heappush(heap, (-(left[rows[i]] + right[columns[j + 1]]), i, j + 1))
        if i + 1 < len(rows) and taken[i + 1] == j:
            heapq.heappush(heap, (-(left[rows[i + 1]] + right[columns[j]]), i + 1, j))


class Block:
    """A packed block of the index opened for search."""

    def __init__(self, row: dict, width: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], np.bool_)
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        norms = np.frombuffer(row["norms"], np.int64)
        self.whole = np.frombuffer(row["x"], np.int32).reshape(row["n"], width)
        self.vectors = v.exact(self.whole, norms)
        self.radii = _radii(row)
        self.starts = np.frombuffer(row["starts"], np.int64)

    def visited(self, books: Codebooks, query: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Places of rows, several cells at a time, and the bound of all cells still to come."""
        held, n = [], 0
        right = len(books.codes[1])
        for bound, i, j in multi_sequence(*books.bounds(query, self.radii)):
            if n >= _STEP:
                yield np.concatenate(held), bound
                held, n = [], 0
            start, end = self.starts[i * right + j : i * right + j + 2]
            if start < end:
                held.append(np.arange(start, end))
                n += end - start
        if n:
            yield np.concatenate(held), -np.inf

    def first(self, places: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
        """Of the rows at `places`, the k first by score and id."""
        return np.lexsort((~self.known[places], self.ids[places], -found))[:k]

    def positives(
        self, books: Codebooks, query: np.ndarray, label: int, own: int, least: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best rows of the label, from `least` on."""
        places, found = np.empty(0, np.int64), np.empty(0, np.int64)
        for cells, ahead in self.visited(books, query):
            same = cells[(self.labels[cells] == label) & (self.rows[cells] != own)]
            reached = v.scores(self.vectors[same], query)
            places = np.concatenate([places, same[reached >= least]])
            found = np.concatenate([found, reached[reached >= least]])
            kept = self.first(places, found, POSITIVES)
            places, found = places[kept], found[kept]
            if len(found) == POSITIVES:
                least = max(least, int(found.min()))
            if ahead < least:
                break
        return places, found

    def negatives(
        self, books: Codebooks, query: np.ndarray, label: int, windows: list[tuple[int, int]]
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window: places and scores of its first rows of other labels."""
        open_ = [(low, high) for low, high in windows if low <= high]
        places, found = np.empty(0, np.int64), np.empty(0, np.int64)
        if open_:
            bottom, top = min(w[0] for w in open_), max(w[1] for w in open_)
            for cells, ahead in self.visited(books, query):
                other = cells[self.labels[cells] != label]
                reached = v.scores(self.vectors[other], query)
                fits = (reached >= bottom) & (reached <= top)
                places = np.concatenate([places, other[fits]])
                found = np.concatenate([found, reached[fits]])
                open_ = [w for w in open_ if not _certified(found, w, ahead)]
                if not open_:
                    break
        made = []
        for low, high in windows:
            inside = np.flatnonzero((found >= low) & (found <= high))
            kept = inside[self.first(places[inside], found[inside], NEGATIVES)]
            made.append((places[kept], found[kept]))
        return made


def _certified(found: np.ndarray, window: tuple[int, int], ahead: float) -> bool:
    """Whether nothing with a score of at most `ahead` changes the first rows of a window."""
    if ahead < window[0]:
        return True
    inside = found[(found >= window[0]) & (found <= window[1])]
    return len(inside) >= NEGATIVES and ahead < np.partition(inside, -NEGATIVES)[-NEGATIVES]


def _radii(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(row[name], np.float64) for name in ("left", "right")]


_PACKED = (
    "n int, ids binary, known binary, rows binary, labels binary, norms binary, x binary, "
    "starts binary, left binary, right binary"
)
_ANCHORS = (
    "row bigint, anchor_id bigint, label bigint, home bigint, x binary, least bigint, "
    "found array<struct<vec_id:bigint,score:bigint>>"
)
_POSITIVES = "row bigint, vec_id bigint, score bigint"
_NEGATIVES = "row bigint, turn int, vec_id bigint, score bigint"
_CODED = "row bigint, vec_id bigint, label bigint, norm2 bigint, x binary, left int, right int"


def _coded(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Vectors with the codes of their halves."""
    arrow = v.arrow_schema(_CODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = books.places(v.matrix(batch.column("x"), width))
            columns = [pa.array(c.astype(np.int32)) for c in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=arrow)

    return vectors.select("row", "vec_id", "label", "norm2", "x").mapInArrow(run, _CODED)


def _packer(books: Codebooks, width: int):
    def pack(rows: pa.Table) -> dict:
        ids, known = v.ids_of(rows["vec_id"].combine_chunks())
        whole = v.matrix(rows["x"], width)
        codes, distances = books.places(whole)
        sizes = [len(c) for c in books.codes]
        cells = codes[0] * sizes[1] + codes[1]
        order = np.argsort(cells, kind="stable")
        made = {"n": len(ids), "known": known[order].tobytes(), "ids": ids[order].tobytes()}
        for name, column in (("rows", "row"), ("labels", "label"), ("norms", "norm2")):
            made[name] = rows[column].to_numpy()[order].tobytes()
        for name, code, distance, size in zip(("left", "right"), codes, distances, sizes):
            radius = np.full(size, -1.0)
            np.maximum.at(radius, code, distance)
            made[name] = radius.tobytes()
        starts = np.searchsorted(cells[order], np.arange(sizes[0] * sizes[1] + 1))
        return made | {"x": whole[order].tobytes(), "starts": starts.astype(np.int64).tobytes()}

    return pack


def _at_home(books: Codebooks, width: int, every: int):
    """The anchors of each block, with the best rows of their label in that block."""
    kinds = v.arrow_schema(_ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block, made = Block(row, width), []
                for a in np.flatnonzero(block.known & (block.ids % every == 0)):
                    label, own = int(block.labels[a]), int(block.rows[a])
                    places, found = block.positives(books, block.whole[a], label, own, _NONE)
                    least = int(found.min()) if len(found) == POSITIVES else _NONE
                    hits = [
                        {"vec_id": int(i) if known else None, "score": int(s)}
                        for i, known, s in zip(block.ids[places], block.known[places], found)
                    ]
                    made.append(
                        (own, int(block.ids[a]), label, row["block"], block.whole[a].tobytes())
                        + (least, hits)
                    )
                if made:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*made), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return run


def _sent(anchors: DataFrame, books: Codebooks, reach: pa.Table) -> DataFrame:
    """Anchors with `block`: every block, but `home`, whose best cell may hold `least` or more."""
    schema = ", ".join(f"{n} {k}" for n, k in anchors.dtypes) + ", blocks array<bigint>"
    arrow, names = v.arrow_schema(schema), reach["block"].to_numpy()
    radii = [
        np.array([np.frombuffer(b, np.float64) for b in reach[side].to_pylist()]).reshape(
            len(names), -1 if len(names) else 0
        )
        for side in ("left", "right")
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for anchor in batch.select(["home", "x", "least"]).to_pylist():
                query = np.frombuffer(anchor["x"], np.int32)
                best = sum(b.max(axis=1, initial=-np.inf) for b in books.bounds(query, radii))
                kept.append(names[(best >= anchor["least"]) & (names != anchor["home"])])
            columns = [*batch.columns, pa.array(kept, arrow[-1].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return anchors.mapInArrow(run, schema).withColumn("block", F.explode("blocks")).drop("blocks")


def _more_positives(books: Codebooks, width: int):
    schema = v.arrow_schema(_POSITIVES)

    def compare(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        parts = []
        for packed in blocks.to_pylist():
            block = Block(packed, width)
            for a in anchors.to_pylist():
                query = np.frombuffer(a["x"], np.int32)
                places, found = block.positives(books, query, a["label"], a["row"], a["least"])
                columns = [
                    pa.array(np.full(len(found), a["row"])),
                    v.nullable(block.ids[places], block.known[places]),
                    pa.array(found),
                ]
                parts.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(parts, schema=schema)

    return compare


def _mined(books: Codebooks, width: int):
    schema = v.arrow_schema(_NEGATIVES)

    def compare(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        parts = []
        for packed in blocks.to_pylist():
            block = Block(packed, width)
            for a in anchors.to_pylist():
                query = np.frombuffer(a["x"], np.int32)
                windows = [
                    (max(low, p["floor"]), high)
                    for p in a["positives"]
                    for low, high in [window(p["score"])]
                ]
                mined = block.negatives(books, query, a["label"], windows)
                for p, (places, found) in zip(a["positives"], mined):
                    columns = [
                        pa.array(np.full(len(found), a["row"])),
                        pa.array(np.full(len(found), p["turn"], np.int32)),
                        v.nullable(block.ids[places], block.known[places]),
                        pa.array(found),
                    ]
                    parts.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(parts, schema=schema)

    return compare


def _windows(positives: DataFrame) -> DataFrame:
    """Per anchor: its positives, and `least`, the lowest score that any of their windows takes.

    `floor` is what a window holds enough of already. A positive below zero has no window.
    """
    low = F.floor(F.col("score").cast("double") * (LEAST_PART / 100 - 1e-9)).cast("bigint") - 1
    return (
        positives.where("score >= 0")
        .groupBy("row")
        .agg(
            F.collect_list(F.struct("turn", "score", "floor")).alias("positives"),
            F.min(F.greatest(low, "floor")).alias("least"),
        )
    )


def _ranked(hits: DataFrame, name: str, most: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    return hits.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def hard_negatives(
    table: DataFrame, every: int = ANCHOR_EVERY, scale: int = SCALE, vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(scale * x), and scores are integer inner products. Anchors are
    rows whose vec_id is divisible by `every`; an anchor's positives are the 5 other rows
    of its label with the highest scores, and each positive's negatives the 10 rows of
    other labels with the highest scores from 30 % to 90 % of the positive's. Ties go to
    the smaller vec_id. Fewer are returned where there are fewer; a positive without
    negatives, as any with a score below zero, has no rows.

    A null label, a null vector, or one with a null or non-finite component takes no part,
    nor does a vector of a squared integer length from 2^61. Shorter vectors count as
    filled up with zeros. A row with a null vec_id is never an anchor, and last among
    ties. Repeated rows are rows of their own. An empty table gives no rows. Further
    columns are ignored.

    Codebooks are fitted on at most SAMPLE_ROWS rows; every row is indexed, and the result
    does not depend on them. Codebooks and the radii of at most MOST_BLOCKS blocks travel
    with tasks. Runs jobs while it is built: vectors, index, anchors, positives and what is
    found at home are checkpointed.
    """
    labelled = table.where("label IS NOT NULL").select("vec_id", "label", vector)
    vectors = v.integer_vectors(labelled, scale, vector, "vec_id", "label")
    rows, size, asking = vectors.agg(
        F.count(F.lit(1)), F.max(F.octet_length("x")), F.count_if(F.col("vec_id") % every == 0)
    ).first()
    width = (size or 0) // 4
    books = Codebooks(v.matrix(v.sample(vectors)["x"], width))
    coded = _coded(vectors, books, width)
    order = ["left", "right", "vec_id", "row"]
    index = v.in_blocks(coded, rows, order, _packer(books, width), _PACKED)
    reach = index.select("block", "left", "right").toArrow()
    parts = -(-asking // v.QUERIES_PER_TASK) or 1

    asked = index.mapInArrow(_at_home(books, width, every), _ANCHORS).checkpoint()
    sent = _sent(asked.drop("found"), books, reach)
    away = v.beside_blocks(sent, index, parts, _more_positives(books, width), _POSITIVES)
    home = asked.select("row", F.inline("found"))
    positives = _ranked(home.unionByName(away), "turn", POSITIVES, "row").checkpoint()

    anchors = asked.select("row", "label", "x", "home")
    mine = _mined(books, width)
    first = _windows(positives.withColumn("floor", F.lit(_NONE)))
    at_home = anchors.join(first, "row").withColumn("block", F.col("home"))
    found = v.beside_blocks(at_home, index, parts, mine, _NEGATIVES).checkpoint()
    # From other blocks only what is as good as the tenth found at home can count.
    held = found.groupBy("row", "turn").agg(
        F.when(F.count(F.lit(1)) >= NEGATIVES, F.min("score")).alias("tenth")
    )
    floor = F.coalesce("tenth", F.lit(_NONE)).alias("floor")
    second = _windows(positives.join(held, ["row", "turn"], "left").select("*", floor))
    away = _sent(anchors.join(second, "row"), books, reach)
    found = found.unionByName(v.beside_blocks(away, index, parts, mine, _NEGATIVES))
    negatives = _ranked(found, "rank", NEGATIVES, "row", "turn")
    return (
        negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(
            positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}),
            ["row", "turn"],
        )
        .join(asked.select("row", "anchor_id"), "row")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )


def op11_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all embeddings, every seventh vec_id with the label after its own."""
    table = v.embeddings(spark, sf_dir)
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table.withColumn("label", moved))


ORACLE = f"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v, row_number() OVER () AS row
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_inner_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id % {ANCHOR_EVERY} = 0 AND c.row <> a.row
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS turn
  FROM scored WHERE same QUALIFY turn <= {POSITIVES}
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.row, p.turn ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.row = p.row AND NOT n.same
  AND {LEAST_PART} * p.score <= 100 * n.score AND 100 * n.score <= {MOST_PART} * p.score
QUALIFY rank <= {NEGATIVES}"""
