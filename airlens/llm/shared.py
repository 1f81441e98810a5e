"""Helpers shared by the text operators: staging, ASCII case, Arrow text buffers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# bytes of text handled at once by the vectorised helpers; bounds their memory
CHUNK_BYTES = 1 << 19


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a local one only where unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/airlens-llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column | str) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def crc_mod(col: Column | str, m: int) -> Column:
    """crc32 of the id as decimal text, modulo ``m``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m if isinstance(col, str) \
        else F.crc32(col.cast("string").cast("binary")) % m


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns, whatever their names, cannot clash with derived ones."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after another, value offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, off


def document_runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of neighbouring values of at most ``limit`` bytes together (a longer value stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def small_batches(batches, rows: int = 512):
    """Record batches of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):   # not the GNU C library
        pass


def map_arrow(df: DataFrame, run: Callable, schema, rows: int = 1024) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches of at most ``rows`` rows, and memory released after a task."""
    def lean(batches):
        try:
            yield from run(small_batches(batches, rows))
        finally:
            release_memory()

    return df.mapInArrow(lean, schema)
