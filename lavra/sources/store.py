"""Files of local, shared and object storage, read and written by tasks; any scheme pyarrow knows (file, s3, gs, hdfs)."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 8 * 1024 * 1024


def at(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path behind a URI or a plain path."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def join(root: str, relative: str) -> str:
    return f"{root.rstrip('/')}/{relative.lstrip('/')}"


def exists(path: str) -> bool:
    system, p = at(path)
    return system.get_file_info(p).type != fs.FileType.NotFound


def read(path: str) -> bytes:
    system, p = at(path)
    with system.open_input_stream(p) as f:
        return f.read()


def write(path: str, pieces: Iterable[bytes]) -> tuple[int, str]:
    """Write a file as a whole, or not at all; its size and SHA-256. A task that is run again writes the same file."""
    system, p = at(path)
    folder, _, name = p.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    size, digest = 0, hashlib.sha256()
    try:
        with system.open_output_stream(draft) as f:
            for piece in pieces:
                f.write(piece)
                digest.update(piece)
                size += len(piece)
        system.move(draft, p)
    except BaseException:
        if system.get_file_info(draft).type != fs.FileType.NotFound:
            system.delete_file(draft)
        raise
    return size, digest.hexdigest()


def _pieces(path: str) -> Iterator[bytes]:
    system, p = at(path)
    with system.open_input_stream(p) as f:
        while piece := f.read(PIECE):
            yield piece


def copy(source: str, target: str) -> tuple[int, str]:
    """Copy a file piece by piece; size and SHA-256 of what was copied."""
    return write(target, _pieces(source))


def delete(path: str) -> bool:
    """Remove a file or a folder with all below it; false where there is nothing."""
    system, p = at(path)
    kind = system.get_file_info(p).type
    if kind == fs.FileType.Directory:
        system.delete_dir(p)
    elif kind == fs.FileType.File:
        system.delete_file(p)
    return kind != fs.FileType.NotFound


def transfer(plan: DataFrame, source: str, target: str, source_root: str, target_root: str, delete_after: bool = False, in_flight: int | None = None) -> DataFrame:
    """``plan`` with size, sha256 and error: its files are copied by the tasks, at most ``in_flight`` at a time.

    A file that fails has its error and no size, the others go on. ``delete_after`` removes a source that was
    copied. Nothing is copied before the result is computed, and again if it is computed again.
    """
    rows = plan if in_flight is None else plan.repartition(in_flight)
    names = plan.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for a, b in zip(pdf[source], pdf[target], strict=True):
                try:
                    size, digest = copy(join(source_root, a), join(target_root, b))
                    if delete_after:
                        delete(join(source_root, a))
                    out.append((size, digest, None))
                except (OSError, ValueError, TypeError, AttributeError) as e:
                    out.append((None, None, f"{type(e).__name__}: {e}"))
            done = pd.DataFrame(out, columns=["size", "sha256", "error"], index=pdf.index)
            yield pd.concat([pdf[names], done.astype({"size": "Int64"})], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema)
    return rows.mapInPandas(run, f"{schema}, size bigint, sha256 string, error string")


def write_texts(rows: DataFrame, name: str, text: str, folder: str) -> DataFrame:
    """(name, size, sha256, error): one UTF-8 file per row, named ``name``; rows without a text are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, t in pdf.itertuples(index=False):
                try:
                    out.append((n, *write(join(folder, n), [t.encode("utf-8", "surrogatepass")]), None))
                except OSError as e:
                    out.append((n, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["name", "size", "sha256", "error"]).astype({"size": "Int64"})

    live = rows.where(F.col(name).isNotNull() & F.col(text).isNotNull()).select(name, text)
    return live.mapInPandas(run, "name string, size bigint, sha256 string, error string")
