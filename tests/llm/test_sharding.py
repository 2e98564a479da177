from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from merchlens.llm import sharding
from tests.llm import corpus

TREE = sharding.uniform_tree(2, 2, 3)


def test_rows_slots_and_checksums(spark):
    docs = corpus.table(spark)
    found = sharding.hash_tree_shards(docs, TREE, sharding.with_new_shard(TREE)).collect()
    expected = Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode()))
        for r in corpus.rows()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 12)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in found}) == len({r.doc_id for r in found})


def test_clashing_columns_and_empty_table(spark):
    docs = corpus.table(spark)
    plain = sharding.hash_tree_shards(docs, TREE)
    assert corpus.bag(plain) == corpus.bag(sharding.hash_tree_shards(corpus.clashing(docs), TREE))
    assert sharding.hash_tree_shards(corpus.table(spark, []), TREE).collect() == []
    assert {r.grown_shard for r in plain.collect()} == {None}


def _shards(spark, tree, keys=4000):
    key = spark.range(keys).selectExpr("id", "cast(id as string) as key")
    placed = key.select("id", sharding.tree_shard(key["key"], tree).alias("shard"))
    return {r.id: r.shard for r in placed.collect()}


def test_all_shards_get_their_weight(spark):
    held = Counter(_shards(spark, TREE).values())
    assert sorted(held) == list(range(12))
    assert all(abs(n - 4000 / 12) < 100 for n in held.values())
    heavy = Counter(_shards(spark, sharding.with_weight(TREE, "g0/k0/s0", 3.0)).values())
    assert 2.2 < heavy[0] / heavy[1] < 3.9
    none = Counter(_shards(spark, sharding.with_weight(TREE, "g0/k0/s0", 0.0)).values())
    assert none[0] == 0


def test_movement_stays_in_the_subtree_whose_weight_changed(spark):
    before = _shards(spark, TREE)
    after = _shards(spark, sharding.with_weight(TREE, "g0/k1/s4", 2.0))
    moved = {k for k in before if before[k] != after[k]}
    assert moved and all(before[k] in (3, 5) and after[k] == 4 for k in moved)
    region = _shards(spark, sharding.with_weight(TREE, "g1", 9.0))
    assert all(region[k] >= 6 for k in before if before[k] != region[k])


def test_a_new_shard_takes_rows_only_into_itself(spark):
    grown, before = sharding.with_new_shard(TREE), _shards(spark, TREE)
    for number in (12, 13):
        after = _shards(spark, grown)
        assert all(after[k] in (before[k], number) for k in before)
        assert 150 < sum(v == number for v in after.values()) < 500
        before, grown = after, sharding.with_new_shard(grown)
