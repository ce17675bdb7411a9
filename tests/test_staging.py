import os
import time

from pyspark.sql import functions as F

from yearwheel.operators.staging import CLEANUP, Staging


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffles_of_a_staged_table_go_when_it_is_written(spark, stage):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    kept = spark.range(10000).withColumn("k", F.col("id") % 97)
    totals = kept.groupBy("k").agg(F.sum("id").alias("s"))
    staged = stage(totals, "totals")
    waited = time.time() + 20
    while shuffle_files(spark) - before and time.time() < waited:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP, None) == setting
    # what was staged, and the frame it came from, can be read again and again
    assert staged.count() == totals.count() == len(totals.collect()) == 97
    assert stage(totals, "again").join(staged, "k").count() == 97


def test_named_tables_are_dropped(spark, tmp_path):
    stage = Staging(spark, str(tmp_path / "some"))
    one, _ = stage(spark.range(3), "one"), stage(spark.range(4), "two")
    stage.drop("two", "never written")
    assert os.listdir(stage.folder) == ["one"] and one.count() == 3
    stage.drop()
    assert not os.path.exists(stage.folder)
