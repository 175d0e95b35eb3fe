"""Written stages leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from stipend.shared import _DROP_SHUFFLES, stage


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(n).getName().startswith("shuffle_") for n in range(files.size()))


def test_shuffles_of_a_written_stage_go(spark):
    before, setting = shuffle_files(spark), spark.conf.get(_DROP_SHUFFLES)
    counts = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count()
    staged = stage(counts.join(spark.range(1000).withColumnRenamed("id", "k").repartition(4), "k"), "kept")
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(_DROP_SHUFFLES) == setting
    assert staged.count() == 1000


def test_files_of_a_stage_hold_so_many_rows(spark):
    staged = stage(spark.range(10).coalesce(1), "few", 4)
    assert len(staged.inputFiles()) == 3 and staged.count() == 10
