"""A feed as a stream in the order of its file names, whatever their modification times.

Spark's own file source takes files by modification time, which copying or restoring a feed changes. Here the place reached in the
feed is the name of the last file taken: a micro-batch has the files after it, in order. A folder that is empty, or not
there yet, gives no rows. A file added under a name before that place is not read. Files are found by pyarrow's
file systems, so the path may also be in an object store or HDFS, and are read by the tasks, one each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemill.sources.jsonl import FEED_FILES, parse_lines
from tidemill.sources.transactions import EVENT

_LINES = 20_000  # of a batch of rows


def _located(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _names(path: str) -> list[str]:
    from pyarrow import fs

    system, root = _located(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file)


def _planned(progress: str) -> str:
    """The last place that a query planned to reach, from its checkpoint."""
    numbers = [int(n) for n in _names(f"{progress}/offsets") if n.isdigit()]
    if not numbers:
        return ""
    system, root = _located(progress)
    with system.open_input_stream(f"{root}/offsets/{max(numbers)}") as file:
        return json.loads(file.read().decode().splitlines()[-1])["file"]


class _File(InputPartition):
    def __init__(self, path: str, name: str):
        super().__init__(None)
        self.path, self.name = path, name


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.pattern = options["path"].rstrip("/"), options.get("files", FEED_FILES)
        self.most = int(options.get("maxfiles", 0))
        self.last = _planned(options["progress"]) if "progress" in options else ""

    def initialOffset(self) -> dict:
        return {"file": ""}

    def _after(self, name: str) -> list[str]:
        return [n for n in _names(self.path) if n > name and fnmatch(n, self.pattern)]

    def latestOffset(self) -> dict:
        new = self._after(self.last)
        if self.most:
            new = new[: self.most]
        return {"file": new[-1] if new else self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.last = max(self.last, end["file"])
        return [_File(self.path, n) for n in self._after(start["file"]) if n <= end["file"]]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        import io

        system, root = _located(partition.path)
        with system.open_input_stream(f"{root}/{partition.name}") as raw:
            text = io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8", errors="replace", newline="\n")
            held: list[str] = []
            for line in text:
                held.append(line.rstrip("\r\n"))
                if len(held) == _LINES:
                    yield _batch(held, partition.name)
                    held = []
            if held:
                yield _batch(held, partition.name)


def _batch(lines: list[str], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([name] * len(lines), pa.string())], ["value", "file"])


class NamedLines(DataSource):
    """Format ``named_lines``: one row for each line (value, file). Options: path, files, maxFiles, progress."""

    @classmethod
    def name(cls) -> str:
        return "named_lines"

    def schema(self) -> str:
        return "value string, file string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def stream_named(
    spark: SparkSession,
    path: str,
    progress: str,
    schema: StructType = EVENT,
    files: str = FEED_FILES,
    max_files: int | None = None,
) -> DataFrame:
    """The events of a feed, each with the name of its ``file``, in the order of the names.

    ``progress`` is the checkpoint of the query that will read the stream: Spark does not tell a source where a restarted query
    stands before it asks how far the feed goes. ``max_files`` limits the files of a micro-batch of a query that runs on; one
    that ends with what is there takes all at once.
    """
    spark.dataSource.register(NamedLines)
    reader = spark.readStream.format(NamedLines.name()).option("files", files).option("progress", progress)
    if max_files is not None:
        reader = reader.option("maxFiles", max_files)
    return parse_lines(reader.load(path), schema, keep=("file",))
