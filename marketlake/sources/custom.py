"""Pluggable source (SRC-10) with the Python Data Source API.

``LandedSource`` streams landed payloads (JSON lines; by default frames with ``conn``,
``frame_no``, ``kind``, ``body``) in order of arrival. Files land in folders ``arrival=<number>``, as
many in a folder as the collector likes; the number is data, so the order is the same on
any storage, whatever the files' times. Folders are listed and files read through Arrow's
file systems (a local path, ``file://``, ``hdfs://``, ``s3://``, ``gs://``), each file in
a task. A file that is not what it should be fails the read (STR-5).

An offset names the last arrival that was read, ``{"arrival": 7}``, and is kept by Spark
in the query's checkpoint; the source keeps nothing of its own. Options: ``path``;
``columns`` (the payload's schema, DDL); ``maxArrivalsPerTrigger`` (admission bound, STR-2), which needs ``checkpoint``, the query's
checkpoint folder: Spark does not tell a restarted reader where the stream stands, so a
reader with a bound looks up the last offset that Spark planned.

It is the extension point a user writes for a feed Spark has no connector
for; built-in file sources stay the fast path.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "conn string, frame_no bigint, kind string, body string"


class _File(InputPartition):
    def __init__(self, root: str, path: str):
        self.root, self.path = root, path


def _at(path: str):
    """Arrow's file system for a path, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), re.sub("^file:", "", path))


def _children(path: str):
    """What lies in a folder; nothing where there is no folder."""
    from pyarrow import fs

    files, at = _at(path)
    return files.get_file_info(fs.FileSelector(at, allow_not_found=True))


def _arrivals(path: str) -> dict[int, str]:
    """Arrival number -> the name of its folder."""
    found = ((re.fullmatch(r"arrival=(\d+)", x.base_name), x.base_name) for x in _children(path))
    return {int(m[1]): name for m, name in found if m}


def _files(path: str, after: int, upto: int) -> list[_File]:
    """The files of the arrivals after one and up to another, in order."""
    out = []
    for n, name in sorted(_arrivals(path).items()):
        if after < n <= upto:
            folder = f"{path.rstrip('/')}/{name}"
            out += [_File(folder, x.base_name) for x in sorted(_children(folder), key=lambda x: x.base_name)
                    if x.is_file and x.base_name.endswith(".json") and x.size]
    return out


def _read(part: _File, columns):
    """Read one landed file as Arrow record batches (no per-row Python objects)."""
    from pyarrow import json as pj
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(columns)
    files, folder = _at(part.root)
    with files.open_input_stream(f"{folder}/{part.path}") as f:
        table = pj.read_json(f, parse_options=pj.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore"))
    yield from table.select(schema.names).to_batches()


def planned(checkpoint: str) -> int | None:
    """The arrival up to which Spark has planned the query of a checkpoint; None for a new one."""
    logs = [x for x in _children(f"{checkpoint.rstrip('/')}/offsets") if x.base_name.isdigit()]
    if not logs:
        return None
    files, folder = _at(f"{checkpoint.rstrip('/')}/offsets")
    with files.open_input_stream(f"{folder}/{max(logs, key=lambda x: int(x.base_name)).base_name}") as f:
        last = f.read().decode().strip().splitlines()[-1]  # one line for the query's single source
    return json.loads(last)["arrival"]


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options, columns):
        self.path, self.columns = options["path"], columns
        self.most = int(options.get("maxArrivalsPerTrigger", 0) or 0)
        self.end: int | None = None
        if self.most:
            if "checkpoint" not in options:
                raise ValueError("maxArrivalsPerTrigger needs checkpoint")
            self.end = planned(options["checkpoint"])

    def initialOffset(self) -> dict:
        return {"arrival": -1}

    def latestOffset(self) -> dict:
        end = -1 if self.end is None else self.end
        ahead = sorted(n for n in _arrivals(self.path) if n > end)
        if ahead:
            self.end = ahead[min(self.most or len(ahead), len(ahead)) - 1]
        return {"arrival": end if self.end is None else self.end}

    def partitions(self, start: dict, end: dict):
        return _files(self.path, start["arrival"], end["arrival"])

    def read(self, partition):
        return _read(partition, self.columns)

    def commit(self, end: dict) -> None:
        pass


class _BatchReader(DataSourceReader):
    def __init__(self, options, columns):
        self.path, self.columns = options["path"], columns

    def partitions(self):
        return _files(self.path, -1, max(_arrivals(self.path), default=-1))

    def read(self, partition):
        return _read(partition, self.columns)


class LandedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marketlake_landed"

    def schema(self) -> str:
        return self.options.get("columns", SCHEMA)

    def reader(self, schema):
        return _BatchReader(self.options, schema)

    def streamReader(self, schema):
        return _StreamReader(self.options, schema)


def register(spark: SparkSession) -> str:
    """Register the source (shipping this module to the Python workers by value)."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedSource)
    return LandedSource.name()


def arrival_source(path: str, checkpoint: str, columns: str = SCHEMA):
    """A pipeline source: landed payloads by arrival, ``capacity`` arrivals a micro-batch."""
    def make(spark: SparkSession, capacity: int | None):
        r = spark.readStream.format(register(spark)).option("path", path).option("columns", columns)
        if capacity:
            r = r.option("maxArrivalsPerTrigger", capacity).option("checkpoint", checkpoint)
        return r.load()
    return make
