"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING, _FALLBACK = "spark.checkpoint.dir", "spark.sql.warehouse.dir"
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in the shared folder named by ``spark.checkpoint.dir``, else beside the warehouse's tables.

    What is there is deleted by ``clear_scratch``, which also runs when the program ends before its session. The warehouse is
    taken only where driver and executors are one machine, or if it is not a folder of that machine.
    """
    base = spark.conf.get(_SETTING, None)
    if base is None:
        warehouse = spark.conf.get(_FALLBACK).rstrip("/")
        if not spark.sparkContext.master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
            raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
        base = f"{warehouse}/_scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can write, if it exists."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, wherever Spark can write, unless it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(target)


def clear_scratch(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Delete the intermediate tables made so far, from number ``since`` on, but for ``keep``; frames that read them cannot be
    used any more. ``scratch_mark`` is the number of the next one."""
    for path in _made[since:]:
        if path != keep:
            delete_path(spark, path)
            _made.remove(path)


def scratch_mark() -> int:
    return len(_made)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _made:
        clear_scratch(spark)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written out as a table, for one that several parts of a plan read and that is dear to compute.

    Each part then reads only its columns of the table. The files outlive lost executors, unlike a cache.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
