"""Pending change files as a Structured Streaming source.

The rows are descriptors (stream, file range), never table rows. An offset is
the published checkpoint with the newest visible file per stream and date, so
a query that restarts goes on where its last batch ended. Index files are
rewritten in place, which a file source would not notice.
"""

from __future__ import annotations

import json
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "db string, table string, version string, partition bigint, date string, start_idx bigint, end_idx bigint, checkpoint_ts string"

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_INDEX = re.compile(r"^CDC(\d+)\.csv$")


class _Files:
    """Listing and reading of small files by URI, in the planning process."""

    def __init__(self, root: str):
        import pyarrow.fs as pafs  # only where files are listed

        self.file = pafs.FileType.File
        self.selector = pafs.FileSelector
        # Planning runs in a process of its own, without the JVM; Hadoop's names of S3 are those of one store.
        for scheme in ("s3a://", "s3n://"):
            root = root.replace(scheme, "s3://", 1) if root.startswith(scheme) else root
        if root.startswith("file:"):
            root = "/" + root.removeprefix("file:").lstrip("/")
        self.fs, self.base = (pafs.LocalFileSystem(), root) if root.startswith("/") else pafs.FileSystem.from_uri(root)

    def names(self, path: str) -> list[str]:
        selector = self.selector(f"{self.base}/{path}", allow_not_found=True)
        return sorted(i.base_name for i in self.fs.get_file_info(selector))

    def text(self, path: str) -> str | None:
        full = f"{self.base}/{path}"
        if self.fs.get_file_info(full).type != self.file:
            return None
        with self.fs.open_input_stream(full) as f:
            return f.read().decode("utf-8")


class _Range(InputPartition):
    def __init__(self, row: tuple):
        self.row = row


class ChangeFileReader(DataSourceStreamReader):
    """Offsets and descriptor rows of the configured tables."""

    def __init__(self, options: dict):
        self.root = options["path"]
        self.tables = [t.strip() for t in options["tables"].split("\n") if t.strip()]
        self.last: dict = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"checkpoint": "0", "streams": "{}"}

    def latestOffset(self) -> dict:
        files = _Files(self.root)
        # The checkpoint comes first: what it covers is visible by then.
        meta = files.text("increment/metadata")
        published = int(json.loads(meta)["checkpoint-ts"]) if meta else 0
        if published <= int(self.last["checkpoint"]):
            return self.last
        seen = json.loads(self.last["streams"])
        streams = {}
        for fqn in self.tables:
            db, table = fqn.split(".", 1)
            home = f"increment/{db}/{table}"
            for version in (n for n in files.names(home) if n.isdigit()):
                for first in files.names(f"{home}/{version}"):
                    if _DATE.match(first):
                        self._visit(files, streams, seen, home, fqn, version, "0", first, f"{version}/{first}")
                    elif first.isdigit():
                        for date in files.names(f"{home}/{version}/{first}"):
                            if _DATE.match(date):
                                self._visit(files, streams, seen, home, fqn, version, first, date, f"{version}/{first}/{date}")
        self.last = {"checkpoint": str(published), "streams": json.dumps(streams, sort_keys=True)}
        return self.last

    @staticmethod
    def _visit(files, streams, seen, home, fqn, version, partition, date, path) -> None:
        """Note the newest date of a stream and its newest file."""
        key = f"{fqn}|{version}|{partition}"
        dates = streams.setdefault(key, {})
        if date < max(seen.get(key, {}), default=""):
            return  # before the active date
        text = files.text(f"{home}/{path}/meta/CDC.index")
        if text is None:
            return  # nothing produced yet
        m = _INDEX.match(text.strip())
        if not m:
            raise ValueError(f"unsupported index file {path}: {text!r}")
        dates[date] = int(m.group(1))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = json.loads(start["streams"]), json.loads(end["streams"])
        out = []
        for key, dates in after.items():
            fqn, version, partition = key.split("|")
            db, table = fqn.split(".", 1)
            active = max(before.get(key, {}), default="")
            for date, idx in dates.items():
                done = before.get(key, {}).get(date, 0)
                if date >= active and idx > done:
                    out.append(_Range((db, table, version, int(partition), date, done + 1, idx, end["checkpoint"])))
        # A checkpoint without files still ends a round.
        return out or [_Range((None, None, None, 0, None, 1, 0, end["checkpoint"]))]

    def read(self, partition):
        if partition is not None:
            yield partition.row

    def commit(self, end: dict) -> None:
        pass


class ChangeFileSource(DataSource):
    """``spark.readStream.format("cdc_files")`` with options ``path`` and ``tables``."""

    @classmethod
    def name(cls) -> str:
        return "cdc_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ChangeFileReader(dict(self.options))


def read_descriptors(spark: SparkSession, source: str, tables: list[str]):
    """Streaming DataFrame of pending file ranges."""
    # The source travels with its code: workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeFileSource)
    return spark.readStream.format("cdc_files").option("tables", "\n".join(tables)).load(source)
