"""Pack token pieces into fixed-length sequences by bounded-space online best-fit.

A document's ids (with the end id) that exceed a sequence are cut into pieces of
exactly one sequence; only the first piece may be shorter. Full pieces are
sequences of their own. The others are dealt at random to packers of about
``share`` pieces, a number that follows the input. A packer keeps at most
``open_bins`` open sequences, found by free space through a bitset: a piece goes where it leaves the
least room, else a new sequence opens; when too many are open, the fullest closes.

Nulls: a null text is empty, a piece of the end id alone. Repeated rows are
packed each for itself; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, document_runs, map_arrow, staged
from airlens.llm.subwords import open_subwords
from airlens.llm.words import mix

OPEN_BINS = 512
SHARE = 1 << 18
TEXT_RUN = 1 << 19

_PIECES = "doc long, piece int, start long, length long, ids_crc32 long, deal long"
_PACKED = "doc long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """Online best-fit into bins of ``size``; ``place`` returns (bin number, offset)."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.mask = self.n_open = self.opened = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open >= self.open_bins:  # the fullest one closes
                self._take((self.mask & -self.mask).bit_length() - 1)
            free, number = self.size, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.mask |= 1 << left
            self.n_open += 1
        return number, self.size - free


def _cut(path: str, end_id: int, size: int):
    def run(batches):
        sub, dealt = open_subwords(path), 0
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.concatenate([[0], np.cumsum(batch.column(2).fill_null(0).to_numpy(zero_copy_only=False))])
            for i, j in document_runs(sizes, TEXT_RUN):
                ids, counts = sub.encode([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                n_pieces = -(-counts // size)
                doc = np.repeat(np.arange(j - i), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                head = counts - (n_pieces - 1) * size
                start = np.where(piece > 0, head[doc] + (piece - 1) * size, 0)
                length = np.where(piece > 0, size, head[doc])
                at = (np.cumsum(counts) - counts)[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                deal = mix(np.arange(base + dealt, base + dealt + len(doc)).astype(np.uint64))
                dealt += len(doc)
                yield pa.RecordBatch.from_pydict({
                    "doc": batch.column(0).slice(i, j - i).take(pa.array(doc)), "piece": piece.astype(np.int32),
                    "start": start, "length": length, "ids_crc32": np.array(crc, np.int64),
                    "deal": (deal >> np.uint64(1)).astype(np.int64)})
    return run


def _pack(table: pa.Table, size: int, open_bins: int, shares: int) -> pa.Table:
    table = table.take(pa.array(np.argsort(table.column("deal").to_numpy(), kind="stable")))
    bins = BestFit(size, open_bins)
    placed = np.array([bins.place(n) for n in table.column("length").to_pylist()], np.int64)
    share = table.column("share")[0].as_py()
    # numbers of packed sequences are even, those of full pieces odd
    return table.drop(["deal", "share"]).append_column(
        "sequence_id", pa.array(2 * (placed[:, 0] * shares + share))).append_column("offset", pa.array(placed[:, 1]))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, id: str = "doc_id",
                   text: str = "text", open_bins: int = OPEN_BINS, share: int = SHARE) -> DataFrame:
    """Per piece: ``id``, piece, start, length, ids_crc32, sequence_id, offset (see the module text)."""
    one = columns(docs, id, text).select(
        F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"),
        F.octet_length(F.col(f"`{text}`")).alias("size"))
    pieces = staged(one.transform(map_arrow, _cut(tokenizer, end_id, size), _PIECES), "pieces")
    full, part = pieces.where(f"length = {size}"), pieces.where(f"length < {size}")
    shares = max(1, -(-part.count() // share))
    packed = (part.withColumn("share", F.col("deal") % shares).groupBy("share")
              .applyInArrow(lambda t: _pack(t, size, open_bins, shares), _PACKED))
    whole = full.select("doc", "piece", "start", "length", "ids_crc32",
                        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole).withColumnRenamed("doc", id)
