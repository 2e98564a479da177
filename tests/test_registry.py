"""Every named query against its SQL in DuckDB."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from merchlens import registry
from tests.comparison import SAMPLE, differences, duckdb_on

FOLDER = f"{SAMPLE}/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    with duckdb_on(FOLDER) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("package", ["tokenizers", "xxhash", "public_tokenizers"])
def test_entry_goes_without_packages_of_the_optional_part(package):
    code = (
        f"import sys; sys.modules[{package!r}] = None; import __spark_entry__ as e; "
        "from merchlens import registry; assert set(e.queries()) >= set(registry.queries())"
    )
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_entry_is_the_category_classes(spark):
    assert contract.entry(spark).columns == [
        "abc_group",
        "members",
        "revenue",
        "cash_flow",
        "orders",
        "aov",
    ]


def test_sample_queries_count_repeated_customers_once(spark, tmp_path):
    for path in Path(FOLDER).glob("*.parquet"):
        if path.name != "customer.parquet":
            (tmp_path / path.name).symlink_to(path)
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
    customers.union(customers).write.parquet(f"{tmp_path}/customer.parquet")
    once = QUERIES["problem_routes"](spark, FOLDER).collect()
    twice = QUERIES["problem_routes"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, twice))
