"""The corpus operators as named queries, and the SQL that checks those SQL can express."""

from __future__ import annotations

from merchlens.llm import (
    bpe,
    fuzzy,
    hard_negatives,
    jaccard,
    merkle,
    mixing,
    ngram_lm,
    pii,
    pivots,
    quality,
    sharding,
    warc,
    wordpiece,
)


def queries():
    return {
        "op1_hash_tree_shards": sharding.op1_hash_tree_shards,
        "op2_skip_chain_pii": pii.op2_skip_chain_pii,
        "op3_shingle_join": jaccard.op3_shingle_join,
        "op4_piecewise_hash": fuzzy.op4_piecewise_hash,
        "op5_content_archive": warc.op5_content_archive,
        "op6_block_mix": mixing.op6_block_mix,
        "op7_word_piece_counts": wordpiece.op7_word_piece_counts,
        "op8_trie_bpe": bpe.op8_trie_bpe,
        "op9_backoff_scores": ngram_lm.op9_backoff_scores,
        "op10_rule_ledger": quality.op10_rule_ledger,
        "op11_multi_index_negatives": hard_negatives.op11_multi_index_negatives,
        "op12_slot_manifest": merkle.op12_slot_manifest,
        "op13_pivot_search": pivots.op13_pivot_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_hash_tree_shards": sharding.ORACLE,
        "op5_content_archive": warc.ORACLE,
        "op9_backoff_scores": ngram_lm.ORACLE,
        "op10_rule_ledger": quality.ORACLE,
        "op11_multi_index_negatives": hard_negatives.ORACLE,
        "op12_slot_manifest": merkle.ORACLE,
        "op13_pivot_search": pivots.ORACLE,
    }
