from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from merchlens.llm import quality
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in quality.SYMBOLS for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(
            {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        ),
        "n_lines": len(lines),
        "n_upper": sum(c.isupper() and c.isalpha() for c in text),
    }


def test_measurements_equal_a_direct_count(spark):
    got = quality.rule_ledger(corpus.table(spark), keep=("doc_id", "text")).collect()
    assert len(got) == len(corpus.rows())
    for row in got:
        assert {k: row[k] for k in quality.MEASURES} == measured(row.text)


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_measurements_of_random_texts(spark, data):
    alphabet = st.sampled_from(["a", "b", "A", "#", " ", "  ", "\n", "\t", "é", "日", "\x0c", "\xa0"])
    texts = [
        "".join(data.draw(st.lists(alphabet, min_size=0, max_size=60))) for _ in range(150)
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in quality.rule_ledger(docs).collect():
        assert {k: row[k] for k in quality.MEASURES} == measured(texts[row.doc_id])


def test_policies_read_bits(spark):
    ledger = quality.rule_ledger(corpus.table(spark))
    base, current = quality.POLICIES
    rows = ledger.select(
        "*", quality.kept_under(base).alias("base"), quality.kept_under(current).alias("current")
    ).collect()
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base == (not failed) and (r.base or not r.current)
        assert r.current == (r.failures == 0)
    assert any(r.base and not r.current for r in rows)


def test_ablation_counts_by_bits(spark):
    ledger = quality.rule_ledger(corpus.table(spark))
    failures = [r.failures for r in ledger.collect()]
    for row in quality.ablation(ledger).collect():
        policy = next(p for p in quality.POLICIES if p.version == row.version)
        bit = next(1 << r.bit for r in quality.RULES if r.name == row.rule)
        assert row.failing == sum(bool(f & bit) for f in failures)
        assert row.rejected_alone == sum(f & policy.mask() == bit for f in failures)
        assert row.rejected == sum(bool(f & policy.mask()) for f in failures)


def test_empty_table_and_clashing_columns(spark):
    nothing = quality.rule_ledger(corpus.table(spark, []))
    assert nothing.collect() == []
    assert {r.failing for r in quality.ablation(nothing).collect()} == {0}
    docs = corpus.table(spark)
    assert corpus.bag(quality.rule_ledger(docs)) == corpus.bag(
        quality.rule_ledger(corpus.clashing(docs))
    )


def test_ledger_is_one_scan_without_python_or_shuffle(spark):
    plan = quality.rule_ledger(corpus.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == 1  # the table's own repartition
