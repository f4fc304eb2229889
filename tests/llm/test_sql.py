"""The queries that have SQL give its rows, names and types, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from textloom.llm import queries


def table(t):
    t = t.read_all() if hasattr(t, "read_all") else t
    names = sorted(t.schema.names)
    return {f.name: str(f.type) for f in t.schema}, sorted(map(repr, zip(*[t.column(c).to_pylist() for c in names], strict=True)))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    assert table(queries.queries()[name](spark, sf).toArrow()) == table(con.sql(queries.oracle_sql()[name]).arrow())
