"""A log of commits in one folder: files numbered without gaps, each made only if it is not there yet.

Of two writers that start from the same commit one wins, the other gets Conflict and may try again on what is newest then. A
reader lists names and opens the newest commit alone.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from paylake.sources.storage import create_new, delete, file_names, read_text

_FOLDER = "_commits"


class Conflict(RuntimeError):
    """Another writer committed first."""


def _path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{_FOLDER}/c_{number:010d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits that are kept, newest first."""
    names = file_names(spark, f"{root.rstrip('/')}/{_FOLDER}/c_*.json")
    return sorted((int(name[2:-5]) for name in names), reverse=True)


def latest(spark: SparkSession, root: str) -> int | None:
    return next(iter(numbers(spark, root)), None)


def read(spark: SparkSession, root: str, number: int) -> dict:
    """A commit's entry. One that cannot be read is an error: an older version is never served in its place."""
    try:
        return json.loads(read_text(spark, _path(root, number)))
    except (ValueError, Py4JJavaError) as error:
        raise ValueError(f"unreadable commit {_path(root, number)}") from error


def commit(spark: SparkSession, root: str, base: int | None, entry: dict, number: int | None = None) -> int:
    """Commit after ``base``, the newest commit when the work began. Conflict if there is a newer one by now."""
    newest, number = latest(spark, root), number or (base or 0) + 1
    if (newest or 0) != (base or 0) or not create_new(spark, _path(root, number), json.dumps(entry)):
        raise Conflict(f"{root}: commit {newest} came after {base}")
    return number


def forget(spark: SparkSession, root: str, number: int) -> None:
    delete(spark, _path(root, number))
