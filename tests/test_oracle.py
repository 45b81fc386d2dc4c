"""Every registered query against its DuckDB oracle (sf0.001), and every query
without an oracle for a successful run with a stable schema."""

import pytest

from glossa.plans.registry import all_queries
from scripts.check_oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
SLOW = {"review_clusters", "cluster_info"}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.oracle))
def test_matches_oracle(spark, duck, name):
    status, ns, nd, _, info = compare(spark, duck, QUERIES[name], SF)
    assert status == "OK", f"{name}: {status} spark={ns} duck={nd} {info}"


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.oracle and n not in SLOW))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name].build(spark, SF)
    schema = df.schema
    rows = df.collect()
    assert df.schema == schema
    assert isinstance(rows, list)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.oracle))
def test_oracle_column_types(spark, duck, name):
    q = QUERIES[name]
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in q.build(spark, SF).dtypes}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {q.oracle}").fetchall()}
    assert spark_types == duck_types


def test_every_query_documents_coverage():
    for q in QUERIES.values():
        assert q.covers.strip()
