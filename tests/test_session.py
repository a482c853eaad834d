"""Settings that follow the size of the input."""

import pytest

from salesmart.session import MAX_SPLIT, initial_partitions, scan_split, size_shuffles

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SPLIT = "spark.sql.files.maxPartitionBytes"
TIB = 1024**4


def test_scan_tasks_and_partitions_stay_bounded():
    split = 128 * 1024**2
    assert scan_split(10 * TIB, split) == split
    for size in (20 * TIB, 50 * TIB, 100 * TIB):
        assert size / scan_split(size, split) < 110_000
        assert initial_partitions(size, 200) <= 51_200
    assert scan_split(1000 * TIB, split) == MAX_SPLIT


@pytest.mark.parametrize("size", [0, 10**9, 100 * TIB])
def test_settings_of_a_session(spark, size):
    split = spark.conf.get(_SPLIT)
    try:
        size_shuffles(spark, size)
        if size < TIB:
            assert spark.conf.get(_INITIAL, None) is None and spark.conf.get(_SPLIT) == split
        else:
            assert spark.conf.get(_INITIAL) == "51200"
            assert int(spark.conf.get(_SPLIT)) == MAX_SPLIT
    finally:
        spark.conf.unset(_INITIAL)
        spark.conf.unset(_SPLIT)
