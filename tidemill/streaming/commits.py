"""Which folders of a job's output count.

A job writes a folder for each micro-batch, then a marker for it, an empty file whose creation is one step. Readers take the
folders that have a marker, so what a micro-batch left behind when it failed halfway is never seen, and it is
written anew when the micro-batch is run again. Compaction writes one folder with the rows of all batches up to one, then
a marker for that; from then on readers take it in their place. Markers are files ``<n>`` and ``upto=<n>``, and ``open`` for
a folder that the next run takes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.sources.scratch import delete_path, make_folder

_UPTO = "upto="
#: In place of a batch number: what holds until the next run.
OPEN = "open"


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _markers(output: str, table: str) -> str:
    return f"{output}/commits/{table}"


def commit(spark: SparkSession, output: str, table: str, batch: int | str) -> None:
    """Let the folder of a batch of ``table`` count, once all of it is written."""
    make_folder(spark, _markers(output, table))
    fs, target = _files(spark, f"{_markers(output, table)}/{batch}")
    fs.create(target, True).close()


def withdraw(spark: SparkSession, output: str, table: str, batch: int | str) -> None:
    """Let the folder of a batch not count any more, before it is written again."""
    delete_path(spark, f"{_markers(output, table)}/{batch}")


def committed(spark: SparkSession, output: str, table: str) -> list[int]:
    """The batches whose folders count by themselves, in order."""
    merged = max(_compacted(spark, output, table), default=-1)
    return sorted(int(n) for n in _names(spark, _markers(output, table)) if n.isdigit() and int(n) > merged)


def _compacted(spark: SparkSession, output: str, table: str) -> list[int]:
    return sorted(int(n.removeprefix(_UPTO)) for n in _names(spark, _markers(output, table)) if n.startswith(_UPTO))


def _folders(spark: SparkSession, output: str, table: str) -> list[str]:
    merged = _compacted(spark, output, table)[-1:]
    last = [OPEN] if OPEN in _names(spark, _markers(output, table)) else []
    return [f"{output}/compacted/{table}/{_UPTO}{n}" for n in merged] + [
        f"{output}/{table}/batch={n}" for n in [*committed(spark, output, table), *last]
    ]


def read_committed(spark: SparkSession, output: str, table: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The rows of all folders of ``table`` that count now; folders that are added or merged later change nothing."""
    folders = _folders(spark, output, table)
    reader = spark.read.schema(schema).format(fmt)
    return reader.load(folders) if folders else spark.createDataFrame([], schema)


def compact(spark: SparkSession, output: str, table: str, schema: T.StructType | str, fmt: str = "parquet") -> int | None:
    """Merge the folders of ``table`` that count into one; the number of the last batch in it, None if there is nothing to do.

    Readers see the folders before or the merged one, never both. A run that fails leaves things as they were. The folders
    that were replaced stay for readers that have begun, until ``vacuum``. Spark sizes the files of the merged folder.
    """
    batches = committed(spark, output, table)
    if not batches:
        return None
    last = batches[-1]
    folders = [f for f in _folders(spark, output, table) if not f.endswith(f"batch={OPEN}")]
    rows = spark.read.schema(schema).format(fmt).load(folders).hint("rebalance")
    rows.write.mode("overwrite").format(fmt).save(f"{output}/compacted/{table}/{_UPTO}{last}")
    commit(spark, output, table, f"{_UPTO}{last}")
    return last


def vacuum(spark: SparkSession, output: str, table: str) -> None:
    """Delete what a merged folder has replaced, when no reader that began before the merge is left."""
    merged = _compacted(spark, output, table)
    if not merged:
        return
    for name in _names(spark, _markers(output, table)):
        if name == OPEN:
            continue
        old = int(name.removeprefix(_UPTO))
        if name.startswith(_UPTO) and old < merged[-1]:
            delete_path(spark, f"{output}/compacted/{table}/{name}")
        elif not name.startswith(_UPTO) and old <= merged[-1]:
            delete_path(spark, f"{output}/{table}/batch={name}")
        else:
            continue
        delete_path(spark, f"{_markers(output, table)}/{name}")
