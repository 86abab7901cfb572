"""Daily folders that are replaced as a whole: ``<key>=<day>/run=<version>``.

A rewrite goes to a folder of its own. Once it is complete, an empty file named like the
version is made below ``_current``, which is one atomic step on file systems and object
stores alike, and the same for a day with rows and one without. Readers take the newest
version named there, so they see the old or the new day, never none or both. The
version before stays for readers that have begun with it; older ones are removed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

VERSION_KEY = "run"
_MARKS = "_current"


class Folders:
    """Listing, marking and removing through the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, base: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.base = base
        self.files = self._path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, *parts: str) -> list[str]:
        folder = self._path("/".join((self.base, *parts)))
        if not self.files.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(folder))

    def mark(self, *parts: str) -> None:
        self.files.create(self._path("/".join((self.base, *parts))), True).close()

    def remove(self, *parts: str) -> None:
        self.files.delete(self._path("/".join((self.base, *parts))), True)


def publish(
    spark: SparkSession, base: str, key: str, day: str, write: Callable[[str], object]
) -> str:
    """Let ``write`` fill a new version of a day, then make it the current one; its path."""
    folders, place = Folders(spark, base), f"{key}={day}"
    known = folders.names(_MARKS, place)
    # Later than any version before, also if clocks differ.
    newest = int(known[-1].split("-")[0]) if known else 0
    version = f"{max(time.time_ns(), newest + 1):020d}-{uuid.uuid4().hex[:8]}"
    path = f"{base}/{place}/{VERSION_KEY}={version}"
    try:
        write(path)
    except BaseException:
        folders.remove(place, f"{VERSION_KEY}={version}")
        raise
    folders.mark(_MARKS, place, version)
    for old in known[:-1]:
        folders.remove(_MARKS, place, old)
    # Also what writers left that ended before they could mark it.
    for name in folders.names(place) if known else []:
        if name.startswith(f"{VERSION_KEY}=") and name < f"{VERSION_KEY}={known[-1]}":
            folders.remove(place, name)
    return path


def current(spark: SparkSession, base: str, key: str) -> dict[str, str]:
    """The path of the current version of every day, in order.

    A day that was written without versions is its plain folder.
    """
    folders = Folders(spark, base)
    found = {
        name.split("=", 1)[1]: f"{base}/{name}"
        for name in folders.names()
        if name.startswith(f"{key}=")
    }
    marked = folders.names(_MARKS)
    for place in marked:
        day, versions = place.split("=", 1)[1], folders.names(_MARKS, place)
        if versions:
            found[day] = f"{base}/{place}/{VERSION_KEY}={versions[-1]}"
    # A first version that is still being written.
    plain = [d for d, path in found.items() if f"/{VERSION_KEY}=" not in path]
    for day in plain:
        names = folders.names(f"{key}={day}")
        if names and all(n.startswith(f"{VERSION_KEY}=") for n in names):
            del found[day]
    return dict(sorted(found.items()))
