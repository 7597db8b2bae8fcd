"""File trees as a Spark data source: every file, hidden ones included, with or without its content.

The driver only lists folders until there are enough of them to share out; each task walks its own folders.
The wanted extensions are an option, and filters on ``ext`` are pushed into the walk where the session allows it
(spark.sql.python.filterPushdown.enabled), so that the content of other files is never read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

META = "path string, relative_path string, name string, ext string, length bigint"


#: Entries beyond which a folder is shared out by name instead of being listed on the driver.
WIDE = 10_000


class _Share(InputPartition):
    """Folders to walk whole, single files, and parts of wide folders: (folder, part, parts)."""

    def __init__(self, folders: list[str], files: list[str], parts: list[tuple[str, int, int]] = ()):
        self.folders, self.files, self.parts = folders, files, parts


def _entries(folder: str, most: int) -> list[os.DirEntry] | None:
    """The entries of a folder, None if there are more than ``most``."""
    with os.scandir(folder) as entries:
        out = list(islice(entries, most + 1))
    return out if len(out) <= most else None


def extension_of(name: str) -> str:
    """As a path library has it: hidden names and names that end in a dot have none."""
    stem, dot, ext = name.lstrip(".").rpartition(".")
    return f".{ext.lower()}" if stem and dot and ext else ""


class TreeReader(DataSourceReader):
    def __init__(self, root: str, content: bool, shares: int, max_bytes: int | None, extensions: set[str] | None):
        self.root, self.content, self.shares, self.max_bytes, self.extensions = root, content, shares, max_bytes, extensions

    def partitions(self) -> list[_Share]:
        folders, files, parts = [self.root], [], []
        while folders and len(folders) < self.shares:
            deeper: list[str] = []
            for d in folders:
                entries = _entries(d, WIDE)
                if entries is None:  # the tasks list it, each keeps the names of its part
                    parts += [(d, k, self.shares) for k in range(self.shares)]
                    continue
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        deeper.append(e.path)
                    elif e.is_file():
                        files.append(e.path)
            if not deeper:
                folders = []
                break
            folders = deeper
        folders.sort()
        files.sort()
        n = max(1, min(self.shares, len(folders) + len(files) + len(parts)))
        return [_Share(folders[k::n], files[k::n], parts[k::n]) for k in range(n)]

    def read(self, share: _Share) -> Iterator[tuple]:
        def walk() -> Iterator[str]:
            yield from share.files
            folders = list(share.folders)
            for d, part, n in share.parts:
                with os.scandir(d) as entries:
                    for e in entries:
                        if zlib.crc32(os.fsencode(e.name)) % n == part:
                            if e.is_dir(follow_symlinks=False):
                                folders.append(e.path)
                            elif e.is_file():
                                yield e.path
            for d in folders:
                for at, _, names in os.walk(d):
                    for name in names:
                        yield os.path.join(at, name)

        for path in walk():
            name = os.path.basename(path)
            ext = extension_of(name)
            if self.extensions is not None and ext not in self.extensions:
                continue
            try:
                size = os.path.getsize(path)
            except OSError:
                continue  # gone since it was listed, or a broken link
            row = (path, os.path.relpath(path, self.root).replace(os.sep, "/"), name, ext, size)
            if not self.content:
                yield row
            elif self.max_bytes is None or size <= self.max_bytes:
                with open(path, "rb") as f:
                    yield (*row, f.read())
            else:
                yield (*row, None)


class FilteringTreeReader(TreeReader):
    """Takes over filters on ``ext``; Spark refuses readers with this method where push-down is switched off."""

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("ext",):
                values = {f.value}
            elif isinstance(f, In) and f.attribute == ("ext",):
                values = set(f.value)
            else:
                yield f
                continue
            self.extensions = values if self.extensions is None else self.extensions & values


class FileTree(DataSource):
    """Options: path (the root), content ('true' reads the bytes), shares (tasks), max_bytes (larger files have
    null content), extensions (comma-separated, all if unset), push ('true' takes over filters)."""

    @classmethod
    def name(cls) -> str:
        return "lavra_files"

    def schema(self) -> str:
        return META + (", content binary" if self.options.get("content", "true") == "true" else "")

    def reader(self, schema) -> TreeReader:
        limit, wanted = self.options.get("max_bytes"), self.options.get("extensions")
        kind = FilteringTreeReader if self.options.get("push") == "true" else TreeReader
        return kind(os.path.abspath(self.options["path"]), self.options.get("content", "true") == "true", int(self.options.get("shares", "64")), int(limit) if limit else None, set(wanted.split(",")) if wanted else None)


def input_root(folder: str | None, project: str | None = None) -> str:
    """The folder to scan: relative ones are below ``project``; its 'pdfs' subfolder if there is one."""
    if not folder:
        raise FileNotFoundError("no input folder is set")
    if not os.path.isabs(folder):
        folder = os.path.join(project or os.getcwd(), folder)
    if not os.path.isdir(folder):
        raise FileNotFoundError(folder)
    below = os.path.join(folder, "pdfs")
    return below if os.path.isdir(below) else folder


def scan(spark: SparkSession, folder: str, content: bool = True, shares: int = 64, max_bytes: int | None = None, extensions: list[str] | None = None) -> DataFrame:
    """All files below a folder; order by ``path`` where an order is needed. An empty folder has no rows."""
    spark.dataSource.register(FileTree)
    options = {"path": folder, "content": str(content).lower(), "shares": str(shares), "push": spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")}
    options |= {"max_bytes": str(max_bytes)} if max_bytes is not None else {}
    options |= {"extensions": ",".join(extensions)} if extensions else {}
    return spark.read.format("lavra_files").options(**options).load()
