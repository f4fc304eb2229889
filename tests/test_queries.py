"""Every query with SQL gives the SQL's rows, names and types, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from textloom.plans import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def table(t):
    t = t.read_all() if hasattr(t, "read_all") else t
    names = sorted(t.schema.names)
    return {f.name: str(f.type) for f in t.schema}, sorted(map(repr, zip(*[t.column(c).to_pylist() for c in names], strict=True)))


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_as_sql(spark, duck, name):
    assert table(Q.QUERIES[name](spark, SF).toArrow()) == table(duck.sql(Q.SQL[name]).arrow())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_two_runs_agree(spark, name):
    first, second = (table(Q.QUERIES[name](spark, SF).toArrow()) for _ in range(2))
    assert first == second and first[1]
