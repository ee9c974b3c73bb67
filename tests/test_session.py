"""Session contract: an existing (cluster) session is used as is; checkpoints follow its setting."""

from tavola.session import ensure_checkpoint_dir, get_spark


def test_existing_session_returned_untouched(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = get_spark("other-name", master="local[2]", spark__sql__shuffle__partitions="2")
        assert again is spark
        assert again.conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_checkpoint_dir_follows_session_setting(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and spark.sparkContext.getCheckpointDir() == folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:  # the shared folder named by the cluster wins over any scratch folder
        assert folder.replace("file:", "").startswith(configured.rstrip("/"))
    assert ensure_checkpoint_dir(spark) == folder  # stable: no new folder per call
