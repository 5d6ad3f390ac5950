import os
import time

import pytest

from millrace import storage


def path_of(df):
    return df._millrace_path.removeprefix("file:")


def test_tables_end_with_their_scope(spark):
    before = storage.materialize(spark.range(3), "kept")
    with storage.Scope(spark):
        inside = storage.materialize(spark.range(5), "inside")
        assert inside.count() == 5 and os.path.isdir(path_of(inside))
    assert not os.path.exists(path_of(inside)) and before.count() == 3
    storage.release(before, spark.range(1))
    assert not os.path.exists(path_of(before))


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def get(self, *_):
            return None

        def isDefined(self):
            return False

        def getCheckpointDir(self):
            return self

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        class _jsc:
            @staticmethod
            def sc():
                return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_small_tables_are_dealt_out(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert storage.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    made = spark.range(100)
    assert storage.spread(made) is made


def test_the_setting_of_the_session_stays(spark):
    name = storage._CLEANUP
    for value in ("false", "true"):
        spark.conf.set(name, value)
        rows = storage.materialize(spark.range(1000).repartition(3), "kept")
        assert rows.count() == 1000 and spark.conf.get(name) == value
    spark.conf.unset(name)


def test_shuffle_files_go_without_a_setting_of_the_session(spark):
    def shuffles():
        return {name for name in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}

    assert spark.conf.get(storage._CLEANUP, None) is None
    before = shuffles()
    rows = storage.materialize(spark.range(1000).repartition(3), "kept")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and rows.count() == 1000
    assert spark.conf.get(storage._CLEANUP, None) is None
