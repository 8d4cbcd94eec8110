"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from tests.conftest import SF_SMALL
from tillroll.registry import QUERIES
from tillroll.sources.adapters import Retail
from tillroll.sources.tables import TABLES

#: Approximate by nature: its recall is measured in test_vector_index.py.
NO_SQL = {"vector_index_topk"}
ORACLE = {k: v for k, v in oracle_sql().items() if k in QUERIES}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (2, round(v, 9)) if not math.isnan(v) else (1, "nan")
    from decimal import Decimal
    if isinstance(v, Decimal):
        return (2, round(float(v), 9))
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (4, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert "segment" in df.columns
    assert df.count() == 150


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) | NO_SQL


def test_entry_without_the_optional_parts(monkeypatch):
    import __spark_entry__
    monkeypatch.setattr(__spark_entry__, "_present", lambda module: False)
    assert set(__spark_entry__.queries()) == set(__spark_entry__.oracle_sql()) | NO_SQL == set(QUERIES)


def test_mapping_keeps_every_row(spark, con):
    """Row counts straight from the parquet tables, not through the mapping."""
    retail = Retail(spark, SF_SMALL)
    lines, parts, events = (con.execute(f"SELECT COUNT(*) FROM {t}").fetchone()[0] for t in ("lineitem", "part", "events"))
    assert retail.purchases.count() == lines
    assert retail.clickstream.count() == events
    keys = {r[0] for r in con.execute("SELECT p_partkey FROM part").fetchall()}
    clicked = {r.product_id for r in retail.clickstream.select("product_id").distinct().collect()} - {None}
    assert clicked <= keys and len(clicked) > 0.9 * parts


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [r.asDict(recursive=True) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    exp = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    key = sorted(cols)
    a = sorted(tuple(_norm(r[c]) for c in key) for r in got)
    b = sorted(tuple(_norm(r[c]) for c in key) for r in exp)
    assert len(a) == len(b)
    assert a == b
