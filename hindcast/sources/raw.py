"""A sink that keeps each row as a file of its own: bodies exactly as they came in.

Tasks write files aside, under names no reader looks at; only the job's commit gives them their
names, and never to one that is there already. A task that runs again, or a job that fails, leaves
no body half written or written twice.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as stores
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "named-files"
SHAPE = "name string, body string"


def store(root: str) -> tuple[stores.FileSystem, str]:
    """The file system of a folder, as tasks without a JVM see it, and the folder's path in it."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    if root.startswith("/"):
        return stores.LocalFileSystem(), root.rstrip("/")
    system, path = stores.FileSystem.from_uri(root)
    return system, path.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: where they are, and what they are to be called."""

    files: list[tuple[str, str]]


class NamedFiles(DataSource):
    """``df.select("name", "body").write.format(FORMAT).option("root", folder)``: ``name`` is the path
    below the folder; a body whose name ends in ``.gz`` is compressed."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SHAPE

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        if overwrite:
            raise ValueError("bodies are only ever added")
        return NamedFilesWriter(self.options["root"])


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, iterator: Iterator) -> Written:
        system, base = store(self.root)
        done = Written([])
        for row in iterator:
            parts = row["name"].split("/")
            if ".." in parts or "" in parts:
                raise ValueError(f"not a name below the folder: {row['name']}")
            folder = "/".join([base, *parts[:-1]])
            system.create_dir(folder, recursive=True)
            aside = f"{folder}/_{uuid.uuid4().hex}-{parts[-1]}"
            body = row["body"].encode()
            with system.open_output_stream(aside, compression=None) as out:
                out.write(gzip.compress(body, mtime=0) if parts[-1].endswith(".gz") else body)
            done.files.append((aside, f"{folder}/{parts[-1]}"))
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = store(self.root)
        for aside, name in _files(messages):
            if system.get_file_info(name).type == stores.FileType.NotFound:
                system.move(aside, name)
            else:
                system.delete_file(aside)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = store(self.root)
        for aside, _name in _files(messages):
            if system.get_file_info(aside).type != stores.FileType.NotFound:
                system.delete_file(aside)


def _files(messages: list[Written | None]) -> list[tuple[str, str]]:
    return [file for message in messages if message is not None for file in message.files]
