"""Rows as files of their own names, by a Spark data source.

``df.write.format("named_files")`` takes rows (name, content) and writes each to
``<path>/<name>``. A task writes to a folder of its attempt; files get their names
when the job commits, so that a failed or repeated task leaves nothing behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

PENDING = "_temporary"


def file_system(path: str):
    """The Arrow file system of a path, and the path in it."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:/*(?=/))?(/.*)", path)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The folder of a task, and how many files it wrote."""

    folder: str
    files: int


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = file_system(self.path)
        folder = f"{PENDING}/{uuid.uuid4().hex}"
        files = 0
        for row in iterator:
            name, content = row["name"], row["content"]
            if not name or name.startswith(("/", "_", ".")) or ".." in name.split("/"):
                raise ValueError(f"not a file name: {name!r}")
            target = f"{root}/{folder}/{name}"
            system.create_dir(target.rpartition("/")[0], recursive=True)
            with system.open_output_stream(target) as out:
                out.write(bytes(content or b""))
            files += 1
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = file_system(self.path)
        for message in messages:
            if not message or not message.files:
                continue
            top = f"{root}/{message.folder}"
            for found in system.get_file_info(fs.FileSelector(top, recursive=True)):
                if found.type == fs.FileType.File:
                    target = f"{root}/{found.path[len(top):].lstrip('/')}"
                    system.create_dir(target.rpartition("/")[0], recursive=True)
                    system.move(found.path, target)
        self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, system, root: str) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{root}/{PENDING}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{PENDING}")


class NamedFiles(DataSource):
    """Writes rows (name string, content binary) as files; a name may have folders."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], overwrite)


def write_files(files: DataFrame, path: str) -> None:
    """Write ``files(name, content)`` below ``path``, one file a row; a file of the same name is replaced.

    A null content is an empty file. Of rows with the same name the last one committed stays.
    """
    files.sparkSession.dataSource.register(NamedFiles)
    files.select("name", files["content"].cast("binary").alias("content")).write.format("named_files").mode("append").save(path)
