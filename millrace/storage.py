"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where the setting is absent and Spark runs in one process.

    On a cluster a folder of one machine would not be seen by the others, so
    the setting is needed there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def spread(df: DataFrame) -> DataFrame:
    """``df`` itself, or its rows dealt over all cores where they come from fewer files than that.

    For work in Python on small tables: one file may be one task. A large table
    has more files than cores and is read as it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = df._jdf.inputFiles()
    return df.repartition(cores) if 0 < len(files) < cores else df


#: Whether Spark removes the shuffle files of a query at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table into the shared folder and read it back.

    The table survives the loss of executors, and plans over it start from the
    files. It is removed when the driver process ends. The shuffle files behind
    it are removed as soon as it is written: nothing reads them again, and
    otherwise they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)  # None unless the session sets it, though Spark has a default
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    _tables.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


_tables: set[str] = set()


@atexit.register
def _release_all() -> None:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    for path in list(_tables) if spark is not None else ():
        _remove(spark, path)


class Scope:
    """Tables that live as long as a ``with`` block: all that are materialised inside it are removed at its end.

    For work whose result is written inside the block; a session that runs
    many queries keeps no tables of those that are done.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> Scope:
        self._before = set(_tables)
        return self

    def __exit__(self, *_) -> None:
        for path in _tables - self._before:
            _remove(self.spark, path)


def release(*tables: DataFrame) -> None:
    """Remove the tables behind materialised DataFrames that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_millrace_path", None)
        if path:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    _tables.discard(path)
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may be gone already
        pass
