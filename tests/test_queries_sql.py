import pytest

from tagloom.plans import reference, training
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"
CASES = [(n, m) for m in (reference, training) for n in m.SQL]


@pytest.mark.parametrize("name,module", CASES, ids=[n for n, _ in CASES])
def test_matches_sql(spark, name, module):
    compare(spark, module.QUERIES[name], module.SQL[name], FOLDER)


def test_every_sql_has_a_query():
    for m in (reference, training):
        assert set(m.SQL) <= set(m.QUERIES)
