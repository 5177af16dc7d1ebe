"""Files of a folder as rows, listed by the executors: a Python data source.

The driver lists the folder's own entries only, one name per class or split, never a file of a sub-folder. Each
sub-folder is a partition whose files a task lists, at any depth, so the listing grows with the cluster; no file
is opened. Names that start with a dot or an underscore are hidden.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length bigint, modified timestamp"
ROWS = 10_000


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool) -> None:
        super().__init__((path, deep))
        self.path, self.deep = path, deep


def _open(path: str):
    """File system, the folder's path in it, and what stands before a path to make it complete."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://") if "://" in path else ("file", ":", path.removeprefix("file:"))
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: path.index(inner)] if inner in path else f"{scheme}{mark}"


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


class FolderReader(DataSourceReader):
    def __init__(self, path: str, suffix: str) -> None:
        self.path, self.suffix = path, suffix

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, inner, _ = _open(self.path)
        entries = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        folders = [e.path for e in entries if e.type == fs.FileType.Directory and not _hidden(e.base_name)]
        return [_Folder(inner, False), *(_Folder(p, True) for p in sorted(folders))]

    def read(self, partition: _Folder) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _, before = _open(self.path)
        waiting = [partition.path]
        while waiting:
            folder = waiting.pop()
            files = []
            for e in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if _hidden(e.base_name):
                    continue
                if e.type == fs.FileType.Directory:
                    waiting += [e.path] if partition.deep else []
                elif e.path.endswith(self.suffix):
                    files.append(e)
            for start in range(0, len(files), ROWS):
                part = files[start : start + ROWS]
                columns = [
                    pa.array([before + e.path for e in part], pa.string()),
                    pa.array([e.size for e in part], pa.int64()),
                    pa.array([e.mtime for e in part], pa.timestamp("us", "UTC")),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["path", "length", "modified"])


class FolderListing(DataSource):
    """``format("folder_listing")`` with the options ``path`` and ``suffix``."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"], self.options.get("suffix", ""))


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Path, length in bytes and time of change of every file below ``folder`` whose name ends in ``suffix``."""
    spark.dataSource.register(FolderListing)
    return spark.read.format("folder_listing").option("suffix", suffix).load(folder)
