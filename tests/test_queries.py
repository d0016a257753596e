import os

import duckdb
import pytest

import __spark_entry__ as entry
from wayglint.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Wide ones, which take longest, are compared at least once for each kind.
SLOW = {"layer_stats_tile14", "layer_stats_urban", "layer_stats_continent", "layer_stats_country", "compile_z8", "compile_urban", "compile_country", "compile_continent"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    tell = lambda v: None if v is None else v if isinstance(v, str) else round(float(v), 9)
    return sorted(str([tell(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in SLOW])
def test_query_equals_its_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in queries.SQL:
        assert rows
        return
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert plain(rows, got.columns) == plain(want.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
