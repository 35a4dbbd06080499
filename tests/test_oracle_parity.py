"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from tests.conftest import SF_SMALL

_con = {}


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    from tools.check_oracle import compare, duck
    con = _con.setdefault("c", duck(SF_SMALL))
    res = compare(spark, SF_SMALL, [name], con=con, verbose=False)[name]
    assert res[0] in ("match", "rows-only"), res


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns[0] == "clv_tier" and df.count() >= 0
