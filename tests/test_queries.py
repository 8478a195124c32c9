"""Every query of the table operators against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from strandwise import file_queries, table_queries  # noqa: F401  (file_queries adds its own)

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in FOLDER.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def _plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return tuple(value) if isinstance(value, list) else value


@pytest.mark.parametrize("name", sorted(table_queries.QUERIES))
def test_query(spark, duck, name):
    df = table_queries.QUERIES[name](spark, str(FOLDER))
    columns, rows = df.columns, df.collect()
    if name not in table_queries.SQL:
        assert rows or name == "strand_bias"
        return
    found = duck.execute(table_queries.SQL[name])
    theirs = [c[0] for c in found.description]
    assert sorted(columns) == sorted(theirs)
    order = sorted(columns)
    ours = sorted((tuple(_plain(r[c]) for c in order) for r in rows), key=repr)
    assert ours == sorted((tuple(_plain(r[theirs.index(c)]) for c in order) for r in found.fetchall()), key=repr)
