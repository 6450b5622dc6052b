"""Every catalogue query, and every rule on boundary rows, against its DuckDB twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from newsweft import plans


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def test_catalogue_reads_tables():
    assert not set(plans.QUERIES) & set(plans.FIXTURES)


@pytest.mark.parametrize("name", sorted(plans.QUERIES | plans.FIXTURES))
def test_query(spark, sf_dir, con, name):
    df = (plans.QUERIES | plans.FIXTURES)[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    sql = plans.ORACLE_SQL | plans.FIXTURE_SQL
    if name not in sql:
        assert rows
        return
    cur = con.execute(sql[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
