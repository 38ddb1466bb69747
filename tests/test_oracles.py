"""Every registered query equals its DuckDB oracle on the smallest test data
(the driver runs the same check at sf0.01)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001

#: The training-data operators have tests of their own and may be absent.
KEYS = sorted(k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k))


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    from tools.compare import compare
    res = compare(spark, SF001, [key], verbose=False)[key]
    assert res[0] in ("OK", "ROWS_ONLY"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["this_week", "previous_week", "num_users", "status"]
    assert df.count() > 0
