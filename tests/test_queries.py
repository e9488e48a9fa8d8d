"""Every reference query against its SQL in DuckDB, on sf0.001."""

import duckdb
import pytest

from textloom.plans import registry

D = "/root/testdata/sf0.001"
ALL = registry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def text(v):
    return "N" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, name):
    df = ALL[name](spark, D)
    rows = df.collect()
    if name not in registry.oracle_sql():
        assert rows
        return
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(text, r)) for r in rows) == sorted(tuple(text(r[i]) for i in order) for r in rel.fetchall())
