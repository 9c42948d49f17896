"""Versions of something that is written to one folder, of which one is current.

A version is a folder `versions/<n>` of its own, which nothing overwrites. It counts once its
manifest is there, and is current once a pointer names it: `current/<m>` holds a version's
number, and the pointer with the greatest m holds. Files appear by renaming them to a name that
did not exist, so that readers see all of a version or the one before it, whatever fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[int]:
    system, at = _files(spark, path)
    if not system.exists(at):
        return []
    names = [status.getPath().getName() for status in system.listStatus(at)]
    return sorted(int(n) for n in names if n.isdigit())


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Let a file appear with all of its text; False if there is one already."""
    system, target = _files(spark, path)
    if system.exists(target):
        return False
    _, draft = _files(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.rename(draft, target):
        return True
    system.delete(draft, False)
    return False


def _text(spark: SparkSession, path: str) -> str | None:
    system, at = _files(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/versions/{version:06d}"


def next_version(spark: SparkSession, root: str) -> int:
    """A number that no version has, complete or not."""
    return max(_names(spark, f"{root.rstrip('/')}/versions"), default=0) + 1


def manifest(spark: SparkSession, root: str, version: int) -> dict | None:
    """What is known of a version; None if it was never completed."""
    text = _text(spark, f"{version_path(root, version)}/{MANIFEST}")
    return None if text is None else json.loads(text)


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The manifests of all complete versions, in order."""
    found = [manifest(spark, root, v) for v in _names(spark, f"{root.rstrip('/')}/versions")]
    return [m for m in found if m is not None]


def complete(spark: SparkSession, root: str, version: int, facts: dict) -> None:
    """Write the manifest of a version whose files are there, and make it the current one."""
    text = json.dumps({"version": version, **facts})
    if not _create(spark, f"{version_path(root, version)}/{MANIFEST}", text):
        raise FileExistsError(f"version {version} of {root} is complete already")
    make_current(spark, root, version)


def make_current(spark: SparkSession, root: str, version: int) -> None:
    if manifest(spark, root, version) is None:
        raise ValueError(f"{root} has no complete version {version}")
    folder = f"{root.rstrip('/')}/current"
    while True:
        place = max(_names(spark, folder), default=0) + 1
        if _create(spark, f"{folder}/{place:06d}", str(version)):
            return


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version that the latest pointer names; None if there is none."""
    folder = f"{root.rstrip('/')}/current"
    places = _names(spark, folder)
    return int(_text(spark, f"{folder}/{places[-1]:06d}")) if places else None
