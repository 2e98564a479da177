"""Registered corpus queries against SQL, and the pipeline against its operators alone."""

from __future__ import annotations

import importlib.util
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from merchlens.llm import bpe, jaccard, mixing, pii, quality, registry
from tests.comparison import SAMPLE, differences, duckdb_on
from tests.llm import corpus
from tests.llm.test_jaccard import by_all_pairs

FOLDER = f"{SAMPLE}/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    with duckdb_on(FOLDER) as connection:
        assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_a_row_per_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, FOLDER).select("doc_id").collect()]
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert sorted(ids) == sorted(r.doc_id for r in documents.select("doc_id").collect())


def test_stages_keep_the_columns(spark):
    docs = corpus.clashing(corpus.table(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert (out.columns, out.dtypes) == (docs.columns, docs.dtypes), name
        out.collect()
    empty = corpus.table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == [], name


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_duplicates",
        "personal_data",
        "source_mix",
        "token_ids",
    ]


def test_pipeline_equals_its_steps_by_hand(spark):
    """Verdicts, groups, masks, takes and tokens taken one document at a time."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = [tuple(r) for r in table.collect()]
    verdict = quality.rule_ledger(table).withColumn(
        "kept", quality.kept_under(quality.POLICIES[-1])
    )
    kept = {r.doc_id for r in verdict.where("kept").collect()}
    passed = [d for d in docs if d[0] in kept]
    first = {r[0] for r in by_all_pairs(passed) if r[0] == r[2]}
    alone = [d for d in passed if d[0] in first]
    # A sample this small holds the whole table, in the same order.
    field = pii.train([pii.excerpt(d[1]) for d in sorted(alone) if pii.excerpt(d[1])])
    masked = [(d[0], pii.masked(d[1], field), *d[2:4], 0) for d in alone]
    mixed = mixing.mixed_documents(spark.createDataFrame(masked, table.schema)).collect()
    library = Tokenizer.from_str(bpe.read_tokenizer())
    wanted = Counter(
        (r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in mixed
    )
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == wanted and len(first) < len(passed) < len(docs)


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, rows without doc_id, and a doc_id in two groups."""
    one, two, three = (corpus.prose(seed, 120) for seed in (1, 2, 3))
    rows = [
        (1, one, "en", "web", 1),
        (1, one, "en", "web", 1),
        (1, one, "de", "web", 1),
        (None, corpus.edited(one, 5, 1), "en", "web", 1),
        (None, two, "en", "web", 1),
        (None, two, "en", "books", 1),
        (1, three, "en", "web", 1),
        (0, corpus.edited(three, 6, 1), "en", "web", 1),
        (9, None, "en", "web", None),
        (9, None, "en", "web", None),
    ]
    out = corpus_pipeline.near_duplicates(spark, corpus.table(spark, rows), FOLDER).collect()
    assert Counter((r.doc_id, r.text, r.lang) for r in out) == Counter(
        [(1, one, "de"), (None, two, "en"), (0, rows[7][1], "en"), *[(9, None, "en")] * 2]
    )


def test_repeated_rows_with_columns_of_no_order(spark):
    """Maps cannot be compared; one row of each group stays all the same."""
    docs = corpus.table(spark, [(1, corpus.prose(1, 60), "en", "web", 1)] * 3 + [(2, None, None, None, None)])
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.rand(3)))
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, FOLDER)
        assert "map" in dict(docs.dtypes)["tags"]
    kept = corpus_pipeline.near_duplicates(spark, corpus.table(spark, [(1, "a b", "en", "w", 1)] * 2).withColumn(
        "tags", F.create_map(F.lit("k"), F.lit(1))
    ), FOLDER)
    assert [(r.doc_id, r.tags) for r in kept.collect()] == [(1, {"k": 1})]
    assert docs.select("doc_id").distinct().collect() == [(1,)]


def test_nothing_else_imports_the_corpus_operators():
    from pathlib import Path

    root = Path(importlib.util.find_spec("merchlens").origin).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "merchlens.llm" not in path.read_text(), path
    assert jaccard.SIMILARITY == 0.75 and jaccard.WIDTH == 5


def test_rows_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch, tmp_path):
    """Files of texts that compress well are far smaller than the rows read from them."""
    corpus.table(spark).write.parquet(f"{tmp_path}/docs")
    docs, plans = spark.read.parquet(f"{tmp_path}/docs"), []
    own = type(docs).checkpoint

    def recorded(frame, *options):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return own(frame, *options)

    monkeypatch.setattr(type(docs), "checkpoint", recorded)
    corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert "SortMergeJoin" in plans[-1] and "BroadcastHashJoin" not in plans[-1]
    mixed = corpus_pipeline.source_mix(spark, docs, FOLDER)
    assert "SortMergeJoin [row_key" in mixed._jdf.queryExecution().executedPlan().toString()
