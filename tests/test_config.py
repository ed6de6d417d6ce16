from logsift.config import cluster_settings, ensure_checkpoint_dir


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 << 30)
    big = cluster_settings(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000  # floor: two tasks per core
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_comes_from_the_session(spark):
    path = ensure_checkpoint_dir(spark)
    assert path and path == spark.sparkContext.getCheckpointDir()
