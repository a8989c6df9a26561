"""Outputs that are replaced without a gap: whole versions, and a pointer published last.

    <path>/_versions/v-<id>/part-...      one folder per version, never changed
    <path>/_published/<number>.v-<id>     an empty file per publication; the last one counts

A file appears at once in any storage, and its name says all, so there is no moment
without a version and none with half of one. A write that fails publishes nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from fleetgrid.store import Store

_VERSIONS = "_versions"
_PUBLISHED = "_published"
_DIGITS = 12

# For so long a replaced version stays, for those who are still reading it.
GRACE_SECONDS = 3600.0


def published_path(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that `path` shows now; None if nothing was published."""
    pointers = Store(spark, path).names(f"{path}/{_PUBLISHED}", folders=False)
    if not pointers:
        return None
    return f"{path}/{_VERSIONS}/{max(pointers).partition('.')[2]}"


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    grace_seconds: float = GRACE_SECONDS,
) -> str:
    """Lets `write` fill a new folder, makes it the version that `path` shows, and removes
    what was replaced, or left behind unpublished, at least `grace_seconds` ago.

    Returns the folder. If `write` fails, `path` goes on showing what it did.
    Publications at the same time are all whole, and the last one counts.
    """
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{_VERSIONS}/{version}"
    write(folder)
    store = Store(spark, path)
    last = max(store.names(f"{path}/{_PUBLISHED}", folders=False), default="0.")
    number = int(last.partition(".")[0]) + 1
    store.create(f"{path}/{_PUBLISHED}/{number:0{_DIGITS}}.{version}")
    _prune(store, path, grace_seconds)
    return folder


def _prune(store: Store, path: str, grace_seconds: float) -> None:
    """A pointer is removed before its version is, so that no pointer lacks its version."""
    before = time.time() - grace_seconds
    pointers = sorted(store.names(f"{path}/{_PUBLISHED}", folders=False).items())
    kept = {pointers[-1][0].partition(".")[2]}
    for (name, _), (_, replaced) in zip(pointers, pointers[1:], strict=False):
        if replaced > before:
            kept.add(name.partition(".")[2])
        else:
            store.delete(f"{path}/{_PUBLISHED}/{name}")
    for version, changed in store.names(f"{path}/{_VERSIONS}", files=False).items():
        if version not in kept and changed <= before:
            store.delete(f"{path}/{_VERSIONS}/{version}")
