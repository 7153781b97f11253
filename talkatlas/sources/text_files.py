"""A sink that writes each row as one text file of a given name."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class TextFiles(DataSource):
    """``df.write.format("text_files").save(path)`` for ``df(file, value)``.

    The text goes to ``path/file`` as it is, in UTF-8.  Tasks write into folders
    of their own, and files come to their place when all tasks are done, so a
    failed or repeated task leaves nothing behind.  ``path`` is a URI of a
    shared file system that Arrow can open.  Files that are there already are
    replaced.
    """

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if schema.fieldNames() != ["file", "value"]:
            raise ValueError("text files are written from the columns file and value")
        return TextFilesWriter(self.options["path"])


class TextFilesWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path
        self.beside = f"_writing-{uuid.uuid4().hex}"

    def _open(self) -> tuple[fs.FileSystem, str]:
        # Hadoop writes local paths with one slash, Arrow wants three.
        uri = self.path.replace("file:/", "file:///", 1) if not self.path.startswith("file://") else self.path
        files, root = fs.FileSystem.from_uri(uri)
        return files, root.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Written:
        files, root = self._open()
        folder, names = f"{self.beside}/{TaskContext.get().taskAttemptId()}", []
        for row in iterator:
            if not row.file or "/" in row.file:
                raise ValueError(f"not a file name: {row.file}")
            files.create_dir(f"{root}/{folder}", recursive=True)
            with files.open_output_stream(f"{root}/{folder}/{row.file}") as out:
                out.write((row.value or "").encode())
            names.append(row.file)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = self._open()
        files.create_dir(root, recursive=True)
        for written in filter(None, messages):
            for name in written.names:
                files.move(f"{root}/{written.folder}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = self._open()
        if files.get_file_info(f"{root}/{self.beside}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.beside}")
