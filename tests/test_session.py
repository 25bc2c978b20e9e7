"""Session helper: a running session is reused unchanged; checkpoint folder resolution."""

from gridmart.session import checkpoint_dir, get_spark


def test_running_session_is_not_reconfigured(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = get_spark()
    assert again is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_checkpoint_dir_local_fallback_is_stable(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first
    assert spark.sparkContext.getCheckpointDir() == first
