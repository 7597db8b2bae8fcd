"""Archives: recognition by content and expansion in memory, one level deep."""

from __future__ import annotations

import io
import os
import subprocess
import tarfile
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from lavra.operators.route import OFFICE

_RAR = b"Rar!\x1a\x07"
Unpack = Callable[[bytes], list[tuple[str, bytes]]]


def kind(content: bytes | None) -> str | None:
    """zip, tar or rar, else None."""
    if not content:
        return None
    if zipfile.is_zipfile(io.BytesIO(content)):
        return "zip"
    if _is_tar(content):
        return "tar"
    return "rar" if content.startswith(_RAR) else None


def _is_tar(content: bytes) -> bool:
    try:
        with tarfile.open(fileobj=io.BytesIO(content)):
            return True
    except (tarfile.TarError, EOFError, OSError, ValueError):
        return False


def is_archive(content: bytes | None, ext: str | None) -> bool:
    """By content; office formats are zip files inside but are documents here."""
    return ext not in OFFICE and kind(content) is not None


def unpack_rar(content: bytes) -> list[tuple[str, bytes]]:
    """Members of a rar file by the 7z program, through memory alone; raises where it is missing or fails."""
    fd = os.memfd_create("archive.rar")
    try:
        with open(fd, "wb", closefd=False) as f:
            f.write(content)
        path = f"/proc/{os.getpid()}/fd/{fd}"
        return [(name, _seven_zip("x", "-so", path, name)) for name in _listed(_seven_zip("l", "-slt", "-ba", "-sccUTF-8", path).decode("utf-8", "replace"))]
    finally:
        os.close(fd)


def _seven_zip(*words: str) -> bytes:
    done = subprocess.run(["7z", *words], capture_output=True)
    if done.returncode:
        raise RuntimeError(f"7z ended with {done.returncode}")
    return done.stdout


def _listed(listing: str) -> list[str]:
    """Names of the files in a technical listing, one block of 'Field = value' lines per entry."""
    blocks = [dict(line.split(" = ", 1) for line in block.splitlines() if " = " in line) for block in listing.replace("\r", "").split("\n\n")]
    return sorted(b["Path"] for b in blocks if "Path" in b and b.get("Folder", "-") != "+" and not b.get("Attributes", "").startswith("D"))


def members(content: bytes, rar: Unpack = unpack_rar) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the files in an archive by name, read in memory: nothing is written to the file system."""
    if _is_tar(content):
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in sorted((m for m in t.getmembers() if m.isfile()), key=lambda m: m.name):
                yield m.name.removeprefix("./"), t.extractfile(m).read()
    elif zipfile.is_zipfile(io.BytesIO(content)):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for m in sorted((m for m in z.infolist() if not m.is_dir()), key=lambda m: m.filename):
                yield m.filename, z.read(m)
    elif content.startswith(_RAR):
        yield from sorted(rar(content))
    else:
        raise ValueError("not an archive that can be unpacked")


def sound_members(content: bytes, rar: Unpack = unpack_rar) -> Iterator[tuple[str, bytes]]:
    """The members of an archive that can be read to its end; a damaged one raises before it gives any member.

    Zip and tar files are read twice, so that one member at a time is in memory.
    """
    if content.startswith(_RAR):
        yield from list(members(content, rar))
        return
    for _ in members(content, rar):
        pass
    yield from members(content, rar)


def _frames(rows: Iterator[tuple[str, bytes | None, str | None]], columns: list[str], budget: int = 16 * 1024 * 1024) -> Iterator[pd.DataFrame]:
    """Rows in frames of some ``budget`` bytes of content."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[1] or b"")
        if size >= budget or len(out) >= 10_000:
            yield pd.DataFrame(out, columns=columns)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=columns)


def _unpacked(rel: str, data: bytes | None, rar: Unpack) -> Iterator[tuple[str, bytes | None, str | None]]:
    try:
        for name, inner in sound_members(data or b"", rar):
            yield f"{rel}/{name}", inner, None
    except Exception as e:  # noqa: BLE001 - any damage of an archive is that archive's error
        yield rel, None, f"{type(e).__name__}: {e}"


def expand(archives: DataFrame, relative: str, content: str, rar: Unpack = unpack_rar) -> DataFrame:
    """(relative, data, error): one row per member, named archive/inner, in the order of names.

    Members are not expanded again. An archive that can't be read to its end gives no member but one row with
    null data and its error, to be sent to an error table; an empty archive gives no row.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for pdf in batches for rel, data in pdf.itertuples(index=False) for row in _unpacked(rel, data, rar))
        yield from _frames(rows, ["relative", "data", "error"])

    return archives.select(relative, content).mapInPandas(unpack, "relative string, data binary, error string")


def logical_files(files: DataFrame, rar: Unpack = unpack_rar) -> DataFrame:
    """(relative_path, content, error): plain files, members of archives, and archives that can't be read with their
    error and no content. Each file is read once; a file that is no archive passes through."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple[str, bytes | None, str | None]]:
            for pdf in batches:
                for rel, ext, data in pdf.itertuples(index=False):
                    if is_archive(data, ext):
                        yield from _unpacked(rel, data, rar)
                    else:
                        yield rel, data, None

        yield from _frames(rows(), ["relative_path", "content", "error"])

    return files.select("relative_path", "ext", "content").mapInPandas(unpack, "relative_path string, content binary, error string")
