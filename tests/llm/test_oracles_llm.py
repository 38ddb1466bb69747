"""Queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from pulselens.llm.queries import ORACLES, Q
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(ORACLES[name]).df()
    got = Q[name](spark, SF001).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    rows = lambda df: sorted(map(str, df[cols].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
