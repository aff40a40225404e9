"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from quillmill.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(value):
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value)
    return format(float(value), ".9g") if hasattr(value, "__float__") and not isinstance(value, str) else str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    ours = catalog.queries()[name](spark, DATA)
    theirs = duck.sql(catalog.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    at = [theirs.columns.index(c) for c in columns]
    expected = sorted(tuple(shown(row[i]) for i in at) for row in theirs.fetchall())
    assert sorted(tuple(shown(v) for v in row) for row in ours.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_gives_the_same_rows_again(spark, name):
    """Queries without SQL: some rows, of a stable schema, the same on another partitioning; their rules are held against literal rows elsewhere."""
    first = catalog.queries()[name](spark, DATA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = catalog.queries()[name](spark, DATA)
        assert first.schema == again.schema
        rows = sorted(map(repr, first.collect()))
        assert rows and rows == sorted(map(repr, again.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
