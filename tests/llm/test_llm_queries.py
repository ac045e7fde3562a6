"""The registered queries that have SQL, and every one of them on empty tables."""

import pytest
from oracle import spark_rows, sql_rows

from tamarack.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    assert spark_rows(QUERIES[name](spark, sf)) == sql_rows(sf, SQL[name])


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert len(rows) == (1 if name.startswith("op1_") else 0)
