"""Driver contract: entry() runs, every query has a name-compatible SQL twin."""

import __spark_entry__ as E
from canvass.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["origin_key", "s_suppkey", "distance", "message"]
    assert df.count() > 0


def test_every_query_has_sql_twin():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


def test_all_queries_run_on_smallest_tables(spark):
    for name in REGISTRY:
        df = E.queries()[name](spark, SF)
        assert len(df.columns) == len(set(df.columns)), name
        df.limit(5).collect()
