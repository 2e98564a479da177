"""Mixing sources to target weights by fixed-length token blocks.

The words of a source, document after document in an order given by a hash, are
packed into blocks of equal length. A source's target fixes how many slots of the mix
it fills; each slot falls into one of the output shards by a uniform draw, so the
counts of a source per shard are multinomial, given its total. Slot t of a source in
one pass over it holds block p(t), where p is a pseudorandom permutation of the block
numbers (a keyed Feistel network walked until it lands inside the range). Slots and
blocks are joined by source and block number, which spreads a large source evenly.

A pass takes each block once, and no target asks for more than two passes. The last
slot of a source is cut so that its words add up to the rounded target.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm.common import WORD, documents, find_package, in_slices, running_before
from merchlens.session import ensure_checkpoint_dir, new_shared_folder

# Weights of the sources in order, repeating; what they share; their bound.
WEIGHTS = (3, 1, 2)
SHARED, BOUND = 1.5, 2

BLOCK_WORDS = 64
SLOTS_PER_SHARD = 4096
SEED = 20240101

# Slots that one row of the slot plan stands for before it is spread out.
_RUN = 4096


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target words of every source in (source, source_size).

    Sources by code point, null last, weigh 3, 1, 2 in turn. Filling all sources in
    proportion to their weights, the one with the smallest bound per weight is full
    first; so with sources in that order, the level of the first that stays below its
    bound is the level of all that do. One row per source goes through one task.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn(
        "source_index", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("source_index") % len(WEIGHTS) + 1).cast("int")
    )
    bound = F.col("source_size").cast("double") * BOUND
    by_level = Window.orderBy(F.col("bound") / F.col("weight"), "source_index")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = SHARED * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("bound").over(before), F.lit(0.0)
    )
    levels = (
        ranked.withColumn("weight", weight.cast("double"))
        .withColumn("bound", bound)
        .withColumn("level", left / F.sum("weight").over(onward))
        .withColumn("place", F.row_number().over(by_level))
    )
    open_ = F.col("bound") > F.col("level") * F.col("weight")
    first_open = F.min(F.when(open_, F.struct("place", "level"))).over(everything)
    share = first_open["level"] * F.col("weight")
    return levels.withColumn("first_open", first_open).select(
        "source",
        "source_index",
        "source_size",
        F.when(first_open.isNull() | (F.col("place") < first_open["place"]), F.col("bound"))
        .otherwise(F.least(share, F.col("bound")))
        .alias("target"),
    )


# ---- permutations and slots --------------------------------------------------------


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of each value under a key."""
    x = values.astype(np.uint64) + np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _feistel(values: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = values >> np.uint64(half), values & mask
    for step in range(3, -1, -1) if back else range(4):
        salt = key * 4 + step + 1
        if back:
            left, right = right ^ (_mixed(left, salt * 0x9E3779B97F4A7C15) & mask), left
        else:
            left, right = right, left ^ (_mixed(right, salt * 0x9E3779B97F4A7C15) & mask)
    return (left << np.uint64(half)) | right


def permuted(values: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """Pseudorandom permutation of range(size), or its inverse."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    out = np.asarray(values, dtype=np.uint64)
    out = _feistel(out, half, key, back)
    while (outside := out >= np.uint64(size)).any():
        out[outside] = _feistel(out[outside], half, key, back)
    return out.astype(np.int64)


def _pass_key(source_index: int, turn: int, seed: int) -> int:
    return (seed << 24) ^ (source_index * BOUND + turn)


def slot_runs(size: int, target: float, source_index: int, seed: int = SEED) -> list[dict]:
    """The passes over one source: turn, number of slots, and words of the last slot."""
    blocks, wanted = -(-size // BLOCK_WORDS), round(target)
    passes, turn = [], 0
    while wanted > 0 and size:
        if wanted >= size:
            slots, last = blocks, BLOCK_WORDS
        else:
            short = blocks * BLOCK_WORDS - size
            tail = int(
                permuted(
                    np.array([blocks - 1]), blocks, _pass_key(source_index, turn, seed), back=True
                )[0]
            )
            slots = -(-wanted // BLOCK_WORDS)
            if slots > tail + 1 or (slots == tail + 1 and wanted > slots * BLOCK_WORDS - short):
                slots = -(-(wanted + short) // BLOCK_WORDS)
                last = wanted + short - (slots - 1) * BLOCK_WORDS
            else:
                last = wanted - (slots - 1) * BLOCK_WORDS
        passes.append({"turn": turn, "slots": slots, "last_words": last})
        wanted -= size
        turn += 1
    return passes


def mix_slots(targets: DataFrame, seed: int = SEED) -> DataFrame:
    """Slots of the mix: shard, source_index, turn, block, and words taken of the block."""
    schema = (
        "source_index int, blocks bigint, turn int, slots bigint, last_words bigint, "
        "shards bigint"
    )

    def passes(batches):
        for frame in batches:
            rows = [
                (r.source_index, -(-r.source_size // BLOCK_WORDS), p["turn"], p["slots"])
                + (p["last_words"], max(1, round(r.all_words / BLOCK_WORDS / SLOTS_PER_SHARD)))
                for r in frame.itertuples()
                for p in slot_runs(r.source_size, r.target, r.source_index, seed)
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    def spread(batches):
        for frame in batches:
            for r in frame.itertuples():
                key = _pass_key(r.source_index, r.turn, seed)
                slot = np.arange(r.run * _RUN, min(r.slots, (r.run + 1) * _RUN))
                words = np.full(len(slot), BLOCK_WORDS)
                words[slot == r.slots - 1] = r.last_words
                yield pd.DataFrame(
                    {
                        "shard": _mixed(slot, ~key).astype(np.uint64) % np.uint64(r.shards),
                        "source_index": r.source_index,
                        "turn": r.turn,
                        "block": permuted(slot, r.blocks, key),
                        "words": words,
                    }
                )

    planned = targets.select(
        "source_index",
        "source_size",
        "target",
        F.sum("target").over(Window.partitionBy()).alias("all_words"),
    ).mapInPandas(passes, schema)
    runs = planned.withColumn(
        "run", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / _RUN).cast("bigint")))
    )
    # Spread the runs of a large source over all tasks before slots are made of them. They
    # are few and small as yet, so without a number adaptive execution would join them again.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(tasks, "source_index", "turn", "run").mapInPandas(
        spread, "shard bigint, source_index int, turn int, block bigint, words bigint"
    )


# ---- documents in the mix ------------------------------------------------------------


def _sized(docs: DataFrame, *more) -> DataFrame:
    """doc_id, source and number of words of every document, checkpointed."""
    find_package(docs.sparkSession)
    ensure_checkpoint_dir(docs.sparkSession)
    words = F.size(F.split(F.regexp_replace(F.trim(_blanks()), " +", " "), " "))
    size = F.when(F.trim(_blanks()) == "", 0).otherwise(words)
    return docs.select(
        "doc_id", "source", F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), *more
    ).checkpoint()


def _blanks():
    return F.translate(F.coalesce(F.col("text"), F.lit("")), "\t\n\x0b\x0c\r", "     ")


def _pieces(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Targets of the sources, and the part of each block that each document fills."""
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = targets.checkpoint()
    named = targets.withColumnRenamed("source", "of_source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    order = [c for c in ("doc_id", "text_hash", "size") if c in rows.columns]
    ties = tuple(c for c in ("row_key",) if c in rows.columns)
    placed = running_before(rows, "source_index", order, F.col("size"), "offset", ties)
    first = F.floor(F.col("offset") / BLOCK_WORDS)
    last = F.floor((F.col("offset") + F.col("size") - 1) / BLOCK_WORDS)
    pieces = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("block_start", F.col("block") * BLOCK_WORDS)
        .withColumn("piece_start", F.greatest(F.col("offset"), "block_start"))
        .withColumn(
            "piece_end",
            F.least(F.col("offset") + F.col("size"), F.col("block_start") + BLOCK_WORDS),
        )
    )
    return targets, pieces


def _taken(targets: DataFrame, pieces: DataFrame, seed: int) -> DataFrame:
    """Pieces with the words each slot takes of them; `taken_end` is null without a slot."""
    # Sized after the sources they are made from, slots would look small enough to broadcast.
    slots = mix_slots(targets, seed).hint("merge")
    end = F.least(F.col("piece_end"), F.col("block_start") + F.col("words"))
    return pieces.join(slots, ["source_index", "block"], "left").withColumn(
        "taken_end",
        F.when(F.col("words").isNotNull(), F.greatest(F.col("piece_start"), end)),
    )


def mixed_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document.

    One row per row of `docs`. A null text has no words; a null source is a source, the
    last in order; documents equal in doc_id and size may swap places in the mix. An
    empty table gives no rows. Other columns are ignored. Sizes and targets are
    checkpointed by jobs while the frame is built.
    """
    sized = _sized(docs)
    targets, pieces = _pieces(sized)
    per_piece = F.coalesce(F.col("taken_end") - F.col("piece_start"), F.lit(0))
    taken = (
        _taken(targets, pieces, seed)
        .groupBy("source_index", "offset", "doc_id", "size", "source_size", "target")
        .agg(F.sum(per_piece).alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )
    named = targets.withColumnRenamed("source", "of_source")
    wordless = (
        sized.where("size = 0")
        .join(named, F.col("source").eqNullSafe(F.col("of_source")))
        .select("doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken"))
    )
    return taken.unionByName(wordless)


_WORDS = re.compile(WORD)


def _excerpt(text: str, runs: list[tuple[int, int]]) -> str:
    """The text from the first to the last word of each run, runs parted by a line break."""
    spans = [m.span() for m in _WORDS.finditer(text)]
    joined: list[list[int]] = []
    for start, end in sorted(runs):
        if joined and joined[-1][1] == start:
            joined[-1][1] = end
        else:
            joined.append([start, end])
    if joined == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[start][0] : spans[end - 1][1]] for start, end in joined)


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """What the mix takes, as rows with the columns of `docs`.

    A document comes once for each pass that takes words of it, with `text` cut to
    these words and `n_chars` counted anew; taken whole, its text is unchanged. Rows
    equal in doc_id and text each come with what they take themselves: rows are
    written once with a key of their own, and sizes and targets checkpointed, by jobs while
    the frame is built.
    """
    folder = new_shared_folder(docs.sparkSession, "mix")
    key = F.monotonically_increasing_id().alias("row_key")
    docs.select(F.struct(*docs.columns).alias("row"), key).write.parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    flat = rows.select("row.doc_id", "row.source", "row.text", "row_key")
    targets, pieces = _pieces(_sized(flat, F.xxhash64("text").alias("text_hash"), "row_key"))
    runs = (
        _taken(targets, pieces, seed)
        .where("taken_end > piece_start")
        .groupBy("row_key", "turn")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("piece_start") - F.col("offset")).alias("start"),
                    (F.col("taken_end") - F.col("offset")).alias("end"),
                )
            ).alias("runs")
        )
    )

    def excerpts(texts: list, taken: list) -> list:
        return [_excerpt(t, [(r["start"], r["end"]) for r in rs]) for t, rs in zip(texts, taken)]

    @F.arrow_udf("string")
    def excerpt(texts: pa.Array, taken: pa.Array) -> pa.Array:
        return in_slices(excerpts, pa.string(), texts, taken)

    # Nor may the rows be broadcast with their texts, whose files may be far smaller.
    cut = rows.join(runs.hint("merge"), "row_key")
    cut = cut.withColumn("taken_text", excerpt(F.col("row.text"), "runs"))
    changed = {
        "text": F.col("taken_text"),
        "n_chars": F.length("taken_text").cast("bigint"),
    }
    return cut.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def op6_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source."""
    return mixed_words(documents(spark, sf_dir))
