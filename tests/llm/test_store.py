"""Stored tables do not leave what was shuffled for them on the disks."""

from pyspark.sql import functions as F

from patronage.llm.common import store

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(name) for f in range(files.size()) if (name := files.apply(f).getName()).startswith("shuffle_")}


def test_shuffle_files_end_with_the_write(spark):
    counted = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before, setting = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    table, _ = store(counted, "test-store")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FILE_CLEANUP, None) == setting
    assert sorted(map(tuple, table.collect())) == [(k, 286 if k < 5 else 285) for k in range(7)]
