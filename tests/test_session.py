from driftwood.session import scale_conf, scratch_path, shared_dir


def test_shared_dir_keeps_the_sessions_checkpoint_folder(spark):
    before = spark.sparkContext.getCheckpointDir()
    base = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before  # never replaced
    assert before.startswith(base) and scratch_path(spark, "x").startswith(base)


def test_scale_conf_sizes_partitions_by_input():
    conf = scale_conf(100 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(scale_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
