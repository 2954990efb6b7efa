"""Members of zip archives as a Spark data source."""

from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterator

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Member(InputPartition):
    def __init__(self, path: str, member: str) -> None:
        self.path, self.member = path, member


class ZipLines(DataSource):
    """Lines of the members of zip files: (archive, member, source_ordinal, line). One task per member.

    Options: path (a file or a pattern of file names in one folder; a local path or the address of any file system
    the workers reach, such as hdfs:// or s3://), member (a suffix, in any case), encoding.
    """

    @classmethod
    def name(cls) -> str:
        return "ziplines"

    def schema(self) -> str:
        return "archive string, member string, source_ordinal bigint, line string"

    def reader(self, schema: object) -> DataSourceReader:
        return _ZipReader(dict(self.options))


def _resolved(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        files, where = _resolved(self.options["path"])
        folder, _, pattern = where.rpartition("/")
        found = sorted(i.path for i in files.get_file_info(arrow_fs.FileSelector(folder or ".")) if fnmatch.fnmatch(i.path.rpartition("/")[2], pattern) and i.is_file)
        suffix, out = self.options.get("member", "").lower(), []
        scheme = self.options["path"].split("://")[0] + "://" if "://" in self.options["path"] else ""
        for path in found:
            with files.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                for member in archive.namelist():
                    if member.endswith("/") or not member.lower().endswith(suffix):
                        continue
                    if member.startswith("/") or ".." in member.split("/"):
                        raise ValueError(f"unsafe member {member} in {path}")
                    out.append(_Member(scheme + path, member))
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        files, path = _resolved(partition.path)
        with files.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(partition.member) as member:
            for n, line in enumerate(io.TextIOWrapper(member, encoding=self.options.get("encoding", "utf-8"), newline="\n"), 1):
                yield partition.path, partition.member, n, line.rstrip("\r\n")


def register(spark: SparkSession) -> None:
    """Makes ``spark.read.format("ziplines")`` known."""
    spark.dataSource.register(ZipLines)
