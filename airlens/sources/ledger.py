"""What a job has finished, so that a run after a failure goes on from there.

A ledger belongs to one key, a digest of the job's options and of its input files (names, lengths,
times): other options or other files are another key and start afresh. A finished table is one small
file ``_done/<key>/<name>``, written after the table; it may hold a value (a folder, a number).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from airlens.sources.paths import exists, listing, read_text, write_new_text


def key_of(spark: SparkSession, options: dict, inputs: list[str]) -> str:
    """Digest of the options and of all files under the input paths."""
    h = hashlib.sha256(repr(sorted(options.items())).encode())
    for path in inputs:
        for entry in sorted(listing(spark, path)):
            h.update(repr(entry).encode())
    return h.hexdigest()[:32]


class Ledger:
    """Finished tables of one key; without a key nothing is remembered."""

    def __init__(self, spark: SparkSession, out: str, key: str | None):
        self.spark, self.folder = spark, f"{out}/_done/{key}" if key else None

    def has(self, *names: str) -> bool:
        return self.folder is not None and all(exists(self.spark, f"{self.folder}/{n}") for n in names)

    def value(self, name: str) -> str:
        return read_text(self.spark, f"{self.folder}/{name}")

    def add(self, name: str, value: str = "") -> None:
        if self.folder is not None and not self.has(name):
            write_new_text(self.spark, f"{self.folder}/{name}", value)
