"""The registered queries over the smallest driver tables, against their SQL where there is one."""

import os
from pathlib import Path

import pytest

from quirefold.llm import queries as q

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query_equals_its_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = q.queries()[name](spark, DATA)
    want = duck.sql(q.ORACLE[name])
    assert sorted(want.columns) == sorted(got.columns)
    at = [want.columns.index(c) for c in sorted(want.columns)]
    assert sorted(repr(tuple(r[c] for c in sorted(got.columns))) for r in got.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
