"""Paths and file systems shared by the sources and sinks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs as pafs
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folders that are listed at a time.
LISTING_THREADS = 32


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a plain path or URI (file, hdfs, s3, gs, ...)."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    return pafs.FileSystem.from_uri(f"{scheme}://{rest}")


def list_files(roots: list[str], suffix: str) -> list[tuple[str, int]]:
    """``(path, size)`` of all files below the roots that end in ``suffix``, sorted.

    Folders are listed side by side, as most of the time goes into waiting for the store. Files
    and folders whose name starts with ``_`` or ``.`` are skipped, as Spark does.
    """
    found: dict[str, int] = {}

    def look(folder: tuple[pafs.FileSystem, str, str]) -> tuple[list, list]:
        fs, prefix, inner = folder
        files, folders = [], []
        for entry in fs.get_file_info(pafs.FileSelector(inner)):
            if entry.base_name[:1] in ("_", "."):
                continue
            if entry.type == pafs.FileType.Directory:
                folders.append((fs, prefix, entry.path))
            elif entry.type == pafs.FileType.File and entry.path.endswith(suffix):
                files.append((prefix + entry.path, entry.size))
        return files, folders

    level = []
    for root in roots:
        fs, inner = open_fs(root)
        inner = inner.rstrip("/")
        remote = "://" in root and not root.startswith("file:")
        prefix = root.rstrip("/").removesuffix(inner) if remote else ""
        info = fs.get_file_info(inner)
        if info.type != pafs.FileType.File:
            level.append((fs, prefix, inner))
        elif info.path.endswith(suffix):
            found[prefix + info.path] = info.size
    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        while level:
            deeper = []
            for files, folders in pool.map(look, level):
                found.update(files)
                deeper += folders
            level = deeper
    return sorted(found.items())


def replace_file(fs: pafs.FileSystem, source: str, target: str) -> None:
    """Rename over ``target``; some file systems refuse that while an older file exists."""
    try:
        fs.move(source, target)
    except OSError:
        fs.delete_file(target)
        fs.move(source, target)


def plain_path(path: Column) -> Column:
    """One spelling per file: ``file:`` URIs become plain paths, others stay as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def decoded_path(path: Column) -> Column:
    """``plain_path`` of a URL-encoded path such as ``_metadata.file_path``."""
    return plain_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)
