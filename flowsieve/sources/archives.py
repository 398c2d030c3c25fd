"""A Spark data source for text files inside ZIP archives: column ``line``, the header left out.

Archives are found by listing a folder, nothing is opened then. A task opens one archive where it lies, reads its
directory at the end of the file and streams the one member, so neither an archive nor a member is ever held whole.
Paths go through ``pyarrow.fs``: local and mounted folders, and the file systems it knows by URI.
"""

from __future__ import annotations

import io
import re
import zipfile
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LINES = 8_192


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; ``file:/a`` is written ``file:///a`` by some and means the same."""
    files, path = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))
    return files, path.rstrip("/")


def make_folder(folder: str) -> None:
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)


@dataclass
class Archive(InputPartition):
    path: str


class ArchiveLines(DataSource):
    """Options: ``path`` (folder), ``member`` (file name, any depth and case), ``archive`` (only archives of that name)."""

    @classmethod
    def name(cls) -> str:
        return "archived_lines"

    def schema(self) -> str:
        return "archive string, line string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["member"].lower(), self.options.get("archive", "").lower())


class _Reader(DataSourceReader):
    def __init__(self, folder: str, member: str, archive: str):
        self.folder, self.member, self.archive = folder, member, archive

    def partitions(self) -> list[Archive]:
        files, root = open_folder(self.folder)
        found = files.get_file_info(pafs.FileSelector(root, recursive=True))
        paths = sorted(f.path for f in found if f.is_file and f.base_name.lower().endswith(".zip"))
        return [Archive(p) for p in paths if not self.archive or p.rsplit("/", 1)[-1].lower() == self.archive]

    def read(self, partition: Archive):
        if partition is None:  # an empty folder has no partitions
            return
        files, _ = open_folder(self.folder)
        name = partition.path.rsplit("/", 1)[-1]
        with files.open_input_file(partition.path) as handle, zipfile.ZipFile(handle) as archive:
            inside = [m for m in archive.namelist() if m.rsplit("/", 1)[-1].lower() == self.member]
            if not inside:
                raise FileNotFoundError(f"{partition.path} holds no {self.member}")
            with archive.open(inside[0]) as packed:
                lines = io.TextIOWrapper(packed, "utf-8-sig", errors="replace")
                next(lines, None)
                held = []
                for line in lines:
                    line = line.rstrip("\r\n")
                    if line:
                        held.append(line)
                    if len(held) == LINES:
                        yield _batch(name, held)
                        held = []
                if held:
                    yield _batch(name, held)


def _batch(name: str, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(lines)), pa.array(lines)], names=["archive", "line"])
