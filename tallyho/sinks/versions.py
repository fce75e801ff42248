"""Published versions: a writer that fails midway leaves the previous output readable.

A *root* folder holds ``versions/<name>`` (written once, never changed) and ``published/``,
one empty marker per publication, ``<number>.<name>``; the highest number is the pointer.  A marker is
made only after its version is written whole, in one file-system call that fails if
it exists, so readers find either the previous version or the new one.  Folders without
a marker are what failed writers left; ``remove_unused`` deletes them and versions that were replaced.

One writer per root at a time (a second one with the same number fails at its marker).
Only Hadoop's file-system API is used, so any store that Spark reaches will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is missing."""
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, folder: str) -> bool:
    """Delete a folder with all that is in it."""
    fs, at = _fs(spark, folder)
    return fs.exists(at) and fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its new parent is made if needed, and an existing target is an error."""
    fs, at = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(at, to):
        raise FileExistsError(target)


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file; raises if it exists."""
    fs, at = _fs(spark, path)
    fs.create(at, False).close()


def published(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """``(number, version)`` of every publication, oldest first."""
    markers = [n.split(".", 1) for n in names(spark, f"{root}/published") if "." in n and not n.startswith(("_", "."))]
    return sorted((int(number), version) for number, version in markers)


def current(spark: SparkSession, root: str) -> str:
    """Folder of the newest published version."""
    found = published(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing published below {root}")
    return f"{root}/versions/{found[-1][1]}"


def publish(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    """Let ``write`` fill a new folder, then point to it; returns the folder."""
    found = published(spark, root)
    number = found[-1][0] + 1 if found else 0
    version = f"v{number:09d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/versions/{version}"
    write(folder)
    create_empty(spark, f"{root}/published/{number:09d}.{version}")
    return folder


def remove_unused(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all versions but the ``keep`` newest published ones (readers of older ones
    must be done); returns the names of the deleted."""
    if keep < 1:
        raise ValueError("keep must be positive")
    found = published(spark, root)
    kept = {version for _, version in found[-keep:]}
    gone = [v for v in names(spark, f"{root}/versions") if v not in kept]
    for number, version in found[:-keep]:  # pointers first: none may lead nowhere
        remove(spark, f"{root}/published/{number:09d}.{version}")
    for version in gone:
        remove(spark, f"{root}/versions/{version}")
    return gone
