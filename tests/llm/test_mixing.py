from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import mixing
from tests.llm import corpus


def shared_out(sizes: dict) -> dict:
    """Targets by rounds: who would be above its bound stops there, the rest is shared anew."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(ordered)}
    stopped: dict = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(stopped.values())
        open_ = [s for s in ordered if s not in stopped]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return stopped | {s: left * weight[s] / total for s in open_}
        stopped |= {s: 2.0 * sizes[s] for s in over}


def test_targets_equal_sharing_in_rounds(spark):
    rng = random.Random(5)
    for n in (1, 2, 3, 17):
        sizes = {f"s{i}": rng.randrange(10 ** rng.randrange(1, 6)) for i in range(n)} | {None: 40}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        wanted = shared_out(sizes)
        assert got == pytest.approx(wanted) and got.keys() == wanted.keys()


def test_permutations():
    for size in (1, 2, 3, 7, 64, 1000, 4097):
        order = mixing.permuted(np.arange(size), size, 99)
        assert sorted(order) == list(range(size))
        assert (mixing.permuted(order, size, 99, back=True) == np.arange(size)).all()
    assert not (mixing.permuted(np.arange(1000), 1000, 1) == np.arange(1000)).all()


def test_slots_add_up_to_the_target():
    rng = random.Random(6)
    for _ in range(300):
        size, source = rng.randrange(1, 2000), rng.randrange(50)
        target = rng.random() * 2 * size
        blocks, words = -(-size // mixing.BLOCK_WORDS), 0
        for run in mixing.slot_runs(size, target, source):
            key = mixing._pass_key(source, run["turn"], mixing.SEED)
            block = mixing.permuted(np.arange(run["slots"]), blocks, key)
            taken = np.full(run["slots"], mixing.BLOCK_WORDS)
            taken[-1] = run["last_words"]
            held = np.minimum(mixing.BLOCK_WORDS, size - block * mixing.BLOCK_WORDS)
            words += np.minimum(taken, held).sum()
        assert words == round(target)


def test_shards_draw_sources_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 512)
    targets = spark.createDataFrame(
        [("a", 0, 400_000, 300_000.0), ("b", 1, 100_000, 100_000.0)],
        "source string, source_index int, source_size bigint, target double",
    )
    slots = mixing.mix_slots(targets).collect()
    held = Counter((r.shard, r.source_index) for r in slots)
    shards = {s for s, _ in held}
    assert len(shards) == 12 and len(slots) == sum(held.values())
    # Multinomial counts: near their mean, and not all alike.
    for source, mean in ((0, 300_000 / 64 / 12), (1, 100_000 / 64 / 12)):
        counts = [held[(s, source)] for s in shards]
        assert len(set(counts)) > 3 and max(abs(c - mean) for c in counts) < 4.5 * mean**0.5
    assert len({(r.source_index, r.turn, r.block) for r in slots}) == len(slots)


def test_slots_are_made_in_many_tasks(spark):
    """Also by adaptive execution, which joins partitions of few rows where it may."""
    targets = spark.createDataFrame(
        [("a", 0, 8_000_000, 6_000_000.0), ("b", 1, 100_000, 100_000.0)],
        "source string, source_index int, source_size bigint, target double",
    )
    tasks = mixing.mix_slots(targets).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 0.5 * sum(r["count"] for r in tasks)


def check(spark, docs, given):
    size = [len((r[1] or "").encode().split()) for r in given]
    sizes: dict = {}
    for r, n in zip(given, size):
        sizes[r[3]] = sizes.get(r[3], 0) + n
    wanted = shared_out(sizes)
    rows = mixing.mixed_words(docs).collect()
    assert Counter((r.doc_id, r.size, r.source_size) for r in rows) == Counter(
        (g[0], n, sizes[g[3]]) for g, n in zip(given, size)
    )
    assert all(r.taken <= 2 * r.size for r in rows)
    taken: Counter = Counter()
    target = {}
    for r in rows:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    for source, words in sizes.items():
        assert target[words] == pytest.approx(wanted[source])
        assert taken[words] == round(wanted[source])
    return rows


def test_every_row_and_exact_totals(spark):
    given = corpus.rows()
    docs = corpus.table(spark)
    rows = check(spark, docs, given)
    again = mixing.mixed_words(corpus.clashing(docs).repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mixing.mixed_words(corpus.table(spark, [])).collect() == []


def test_only_empty_texts(spark):
    given = [r for r in corpus.rows() if not (r[1] or "").strip()]
    rows = mixing.mixed_words(corpus.table(spark, given)).collect()
    assert len(rows) == len(given) and {(r.size, r.taken) for r in rows} == {(0, 0)}


def test_mixed_documents_hold_the_words_taken(spark):
    given = [(i, t, "en", f"s{i % 4}", 1) for i, t in enumerate(corpus.texts()) if t]
    docs = corpus.table(spark, given)
    taken = {r.doc_id: r.taken for r in mixing.mixed_words(docs).collect()}
    texts = {r[0]: r[1] for r in given}
    words: Counter = Counter()
    mixed = mixing.mixed_documents(corpus.clashing(docs))
    assert mixed.columns == corpus.clashing(docs).columns
    for r in mixed.collect():
        assert r.n_chars == len(r.text) and r.source == f"s{r.doc_id % 4}"
        own = r.text.encode().split()
        assert not Counter(own) - Counter(texts[r.doc_id].encode().split())
        words[r.doc_id] += len(own)
    # Both order documents by a hash, of other columns; totals per source agree.
    by_source = lambda c: Counter({s: sum(v for k, v in c.items() if k % 4 == s) for s in range(4)})
    assert by_source(words) == by_source(taken)


def test_repeated_rows_take_their_own_words_only(spark):
    """Rows several times over, also without doc_id and under another source."""
    given = [*corpus.rows(), *corpus.rows()[:6] * 4, *corpus.rows()[-2:] * 3]
    given += [(r[0], r[1], r[2], "elsewhere", r[4]) for r in corpus.rows()[:4]]
    sizes: Counter = Counter()
    held: Counter = Counter()
    for r in given:
        sizes[r[3]] += len((r[1] or "").encode().split())
        held[r[0], r[3]] += len((r[1] or "").encode().split())
    taken: Counter = Counter()
    own: Counter = Counter()
    for r in mixing.mixed_documents(corpus.table(spark, given)).collect():
        taken[r.source] += len(r.text.encode().split())
        own[r.doc_id, r.source] += len(r.text.encode().split())
    for source, target in shared_out(sizes).items():
        assert taken[source] == round(target)
    assert all(words <= 2 * held[row] for row, words in own.items())
