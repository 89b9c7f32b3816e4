"""Stored tables keep many cores busy."""

from foldline import session


def test_a_table_of_one_partition_is_read_by_several_tasks(spark):
    kept = session.stored(spark.range(0, 3 * session.FILE_ROWS + 1, 1, 1))
    assert len(kept.inputFiles()) == 4 and kept.count() == 3 * session.FILE_ROWS + 1
