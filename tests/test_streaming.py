from driftwood.session import scratch_path
from driftwood.streaming.drops import load_new_drops

SCHEMA = "id int, name string, price double"


def test_incremental_drops_equal_batch_load(spark):
    root = scratch_path(spark, "stream-drops")
    target = scratch_path(spark, "stream-target")
    spark.createDataFrame([(1, "a", 1.0), (2, "GrÃ\xa0cia", 2.0)], SCHEMA).write.parquet(f"{root}/2020_01_01_x.parquet")
    ckpt = load_new_drops(spark, root, SCHEMA, 10, "day", target, ["id", "day"])
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([(1, "a2", 1.5), (3, "c", 3.0)], SCHEMA).write.parquet(f"{root}/2020_01_02_x.parquet")
    spark.createDataFrame([(1, "a3", 9.0)], SCHEMA).write.parquet(f"{root}/2020_01_01_y.parquet")
    load_new_drops(spark, root, SCHEMA, 10, "day", target, ["id", "day"], checkpoint=ckpt)
    got = {(r.id, r.day): (r.name, r.price) for r in spark.read.parquet(target).collect()}
    assert got == {(1, "2020_01_01"): ("a3", 9.0), (2, "2020_01_01"): ("Gràcia", 2.0),
                   (1, "2020_01_02"): ("a2", 1.5), (3, "2020_01_02"): ("c", 3.0)}


def test_incremental_drops_partitioned_target(spark):
    root = scratch_path(spark, "stream-drops-p")
    target = scratch_path(spark, "stream-target-p")
    spark.createDataFrame([(1, "a", 1.0)], SCHEMA).write.parquet(f"{root}/2020_01_01_x.parquet")
    spark.createDataFrame([(2, "b", 2.0)], SCHEMA).write.parquet(f"{root}/2020_01_02_x.parquet")
    ckpt = load_new_drops(spark, root, SCHEMA, 10, "day", target, ["id", "day"], partition_by="day",
                          max_files_per_trigger=1)
    before = spark.read.parquet(f"{target}/day=2020_01_01").inputFiles()
    spark.createDataFrame([(2, "b2", 5.0)], SCHEMA).write.parquet(f"{root}/2020_01_02_y.parquet")
    load_new_drops(spark, root, SCHEMA, 10, "day", target, ["id", "day"], checkpoint=ckpt, partition_by="day")
    got = sorted((r.id, r.day, r.name) for r in spark.read.parquet(target).collect())
    assert got == [(1, "2020_01_01", "a"), (2, "2020_01_02", "b2")]
    assert spark.read.parquet(f"{target}/day=2020_01_01").inputFiles() == before
