"""Every registered query of the plans against its SQL oracle on the smallest tables."""
import pytest

import __spark_entry__ as entry
from pagewright.plans import registry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def registered(spark):
    return registry.queries(), registry.oracles()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, registered, name):
    queries, oracle = registered
    df = queries[name](spark, SF_DIR)
    empty_at_this_size = {"tree_orphans"}
    diff = difference(df, duck, oracle[name])
    assert diff is None or (name in empty_at_this_size and diff == "empty result"), diff


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 50 and all(r.max_depth == 1 for r in rows)
