"""Results do not depend on the number of shuffle partitions (1 vs 13) or on
adaptive re-planning: order-free comparison of several order-sensitive jobs."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = ["batches", "donor_rollup", "drop_stale", "nearest_poi", "nearest_by_phase_tolerance",
        "dialogue_replay", "result_report", "latest_per_key", "merge_contacts"]


def _rows(spark, key, parts, aqe):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        return sorted(tuple(r) for r in E.queries()[key](spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", KEYS)
def test_partition_count_invariance(spark, key):
    assert _rows(spark, key, 1, "true") == _rows(spark, key, 13, "false")
