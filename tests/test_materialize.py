"""Written tables leave no shuffle files behind."""

import time

from tessera import session


def test_shuffle_files_go_when_the_table_is_written(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in (str(x) for x in disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}
    setting, before = spark.conf.get(session.SHUFFLE_CLEANUP), shuffles()
    got = session.materialize(spark.range(20000).repartition(7).groupBy("id").count(), "t-shuffle")
    for _ in range(40):  # Spark removes them in the background
        if not shuffles() - before:
            break
        time.sleep(0.25)
    assert not shuffles() - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == setting
    assert got.count() == 20000
