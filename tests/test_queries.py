import pytest
from oracle import compare, connect

from granary.plans import encoded, relational, scans  # noqa: F401
from granary.plans.tables import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        compare(df, con, ORACLES[name])
    else:  # a sample has no SQL: its rows are rows of the table, each once, and about a tenth of them
        assert name == "sample_rows"
        got = [r.o_orderkey for r in df.collect()]
        every = [k for (k,) in con.execute("SELECT o_orderkey FROM orders").fetchall()]
        assert len(set(got)) == len(got) and set(got) <= set(every) and 0.07 < len(got) / len(every) < 0.13
