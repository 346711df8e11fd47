"""Every registered query with SQL against DuckDB over the smallest tables, and what SQL cannot say by hand."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from augury import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr(tuple(str(v) for v in row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF_DIR).toPandas()
    want = con.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_conflicts_and_claims_use_every_order(spark, con):
    tokens = {r[0] for r in con.execute("SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey // 50) > 1").fetchall()}
    found = catalog.QUERIES["ownership_conflicts_all"](spark, SF_DIR).toPandas()
    assert set(found["token"]) == tokens and len({t % 40 for t in tokens}) == 40
    conditions = {r[0] for r in con.execute("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 9 < 8").fetchall()}
    judged = [catalog.QUERIES[q](spark, SF_DIR).toPandas()["condition_id"] for q in ("claims_accepted_all", "claims_blocked_all")]
    assert set(judged[0]) | set(judged[1]) == conditions and len(judged[0]) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
