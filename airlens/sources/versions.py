"""Stored folders that are replaced safely: each version in a folder of its own, and a pointer that names the current one.

A writer makes a new version beside the others and then writes the pointer under a name that sorts after all
before it (``_current-000007`` holding the name of a version); readers follow the last pointer. Until
that one small file is there, every reader sees the old version, whole. No folder that anyone can be reading is
changed or renamed, so it also holds on object stores. A failure at any point leaves the
old version in place; what a failed writer left behind is removed by the next ``clean_up``.

A pointer is written only if no other has its number, so of two writers at once one fails and nothing is lost.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from airlens.sources.paths import delete, files, folders, read_text, write_new_text

_POINTER = re.compile(r"_current-(\d{9})")
KEEP = 2    # versions that clean_up leaves: the current one and the one that slow readers may still hold


def _pointers(spark: SparkSession, path: str) -> list[str]:
    return sorted(name for name in files(spark, path) if _POINTER.fullmatch(name))


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, None if there is none yet."""
    found = _pointers(spark, path)
    return f"{path}/{read_text(spark, f'{path}/{found[-1]}').strip()}" if found else None


def new_version(path: str) -> str:
    """A folder for a version that no reader follows yet."""
    return f"{path}/v-{uuid.uuid4().hex}"


def switch(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version``, a finished folder from ``new_version``, the current one."""
    found = _pointers(spark, path)
    number = int(_POINTER.fullmatch(found[-1]).group(1)) + 1 if found else 1
    write_new_text(spark, f"{path}/_current-{number:09d}", version.rsplit("/", 1)[-1])


def clean_up(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove all but the last ``keep`` versions and their pointers, and folders that no pointer names.

    Not to be run beside a writer: its unfinished version is no pointer's yet.
    """
    found = _pointers(spark, path)
    named = [read_text(spark, f"{path}/{p}").strip() for p in found[-keep:]]
    for name in folders(spark, path):
        if name.startswith("v-") and name not in named:
            delete(spark, f"{path}/{name}")
    for name in found[:-keep]:
        delete(spark, f"{path}/{name}")
