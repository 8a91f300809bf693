"""Complete results under one path: run folders, and a short log that names the current one.

A run is written to a folder of its own and becomes the result by one small file
in ``published``, created only if no other writer took its number. Until then,
and for good if the write fails, readers get the run before. The log keeps
``KEEP`` entries: each publication removes the run that falls out of it, so neither
the log nor the work of a delivery grows with the number of deliveries.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Below a path: a file for each published run, named by its rising number.
LOG = "published"
#: Runs that stay: the current one, and the one before for readers that hold it.
KEEP = 2


@dataclass(frozen=True)
class Entry:
    """One published run; ``key`` tells what it was made from, if the writer said so."""

    number: int
    run: str
    key: str | None = None


def _storage(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds the path, whichever it is, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _is(error: Py4JJavaError, *kinds: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in kinds


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; no matter if it is gone."""
    storage, place = _storage(spark, path)
    storage.delete(place, True)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The published runs that are still kept, oldest first; none for a path that nothing was published at."""
    storage, folder = _storage(spark, f"{path}/{LOG}")
    try:
        files = sorted(f.getPath().getName() for f in storage.listStatus(folder))
    except Py4JJavaError as missing:
        if _is(missing, "FileNotFoundException", "ParentNotDirectoryException"):
            return []
        raise
    found = []
    for name in filter(str.isdigit, files):
        content = _content(spark, f"{path}/{LOG}/{name}")
        if content:  # empty: its writer has not finished, or never will
            found.append(Entry(int(name), **json.loads(content)))
    return found


def _content(spark: SparkSession, path: str) -> str:
    storage, place = _storage(spark, path)
    try:
        stream = storage.open(place)
    except Py4JJavaError as gone:
        if _is(gone, "FileNotFoundException"):
            return ""
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the run published last, or None."""
    found = entries(spark, path)
    return f"{path}/{found[-1].run}" if found else None


def resolve(spark: SparkSession, path: str) -> str:
    """The current run if something was published at the path, else the path itself: a plain file or folder."""
    return current(spark, path) or path


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Writes a file unless it exists."""
    storage, place = _storage(spark, path)
    try:
        stream = storage.create(place, False)
    except Py4JJavaError as taken:
        if _is(taken, "FileAlreadyExistsException"):
            return False
        raise
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True


def replace(spark: SparkSession, path: str, write: Callable[[str], None], key: str | None = None) -> bool:
    """Has ``write`` fill a new run folder, then makes it the result. False if ``key`` is published already.

    A write that fails leaves the result as it was and its own folder is removed.
    The key makes a replayed batch publish once.
    """
    if key is not None and any(e.key == key for e in entries(spark, path)):
        return False
    run = f"run-{uuid.uuid4().hex}"
    try:
        write(f"{path}/{run}")
    except BaseException:
        remove(spark, f"{path}/{run}")
        raise
    content = json.dumps({"run": run, "key": key})
    while True:
        found = entries(spark, path)
        number = found[-1].number + 1 if found else 0
        if _create(spark, f"{path}/{LOG}/{number:020d}", content):
            break
    for old in found[: 1 - KEEP]:
        remove(spark, f"{path}/{old.run}")
        remove(spark, f"{path}/{LOG}/{old.number:020d}")
    return True
