"""Token ids of documents as canonical length-limited Huffman files, and back.

``write_tokens`` puts a folder of two Parquet containers in place:

* ``codes``: one row with the code length of every id (0: unused). Lengths come
  from the id counts of the whole corpus by package-merge, at most ``max_bits``.
* ``blocks``: rows (shard, block, first, n_tokens, payload). A shard is a range
  of document ids, blocks count up inside it, ``first`` is the number of ids of
  the shard before the block. A payload decodes on its own: magic, counts, ids
  and lengths of its documents, the bit offset of every ``STEP``-th id, then the bits.

Spark's own writer and commit protocol make the files, so any file system and
lost executors are fine. Documents are in ascending order of id (null first);
rows of the same id stand in order of their text, and each keeps its own entry.
A null text is empty and holds the end id alone. A block holds whole documents,
so a very long text makes one long block. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm.shared import columns, document_runs, map_arrow, staged
from airlens.llm.subwords import open_subwords

MAGIC = b"HUF1"
BLOCK = 1 << 17   # ids after which a block ends with its document
STEP = 128        # ids between two bit offsets
MAX_BITS = 16     # longest code; raised where the vocabulary needs more
TEXT_RUN = 1 << 19

_STAGE = "shard int, block int, first long, n_tokens long, docs binary, ids binary"
_BLOCKS = "shard int, block int, first long, n_tokens long, payload binary"
_DOC = np.dtype([("doc", "<i8"), ("known", "<u8"), ("n", "<i8")])


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for counts (0: no code), by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    max_bits = max(max_bits, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    level, leaf = weight, [np.ones(len(weight), bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaf.append(by < len(weight))
    need, found = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for flags in reversed(leaf):
        leaves = int(flags[:need].sum())
        found[:leaves] += 1
        need = 2 * (need - leaves)
    lengths[order] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: ascending by length, then by symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    for symbol, size in zip(order.tolist(), lengths[order].tolist()):
        code <<= size - last
        codes[symbol], last = code, size
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbol, length) for every value of the next ``bits`` bits."""
    bits = max(1, int(lengths.max(initial=1)))
    symbol, size = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = 1 << (bits - lengths[order].astype(np.int64))
    filled = int(span.sum())
    symbol[:filled] = np.repeat(order, span)
    size[:filled] = np.repeat(lengths[order], span)
    return symbol, size, bits


def encode_block(ids: np.ndarray, docs: bytes, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, off = at >> 5, at & 31
    value = codes[ids] << (64 - off - size).astype(np.uint64)
    out = np.zeros(int(ends[-1] if len(ends) else 0) // 32 + 3, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    marks = at[::STEP].astype("<u8").tobytes()
    head = np.array([len(ids), len(docs) // _DOC.itemsize, STEP], "<u8").tobytes()
    return MAGIC + head + docs + marks + out.astype(">u4").tobytes()


def decode_block(payload: bytes, symbol: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document records) of one payload; stretches between bit offsets decode side by side."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, n_docs, step = np.frombuffer(payload, "<u8", 3, 4).astype(np.int64)
    docs = np.frombuffer(payload, _DOC, n_docs, 28)
    at = 28 + n_docs * _DOC.itemsize
    lanes = -(-n // step)
    place = np.frombuffer(payload, "<u8", lanes, at).astype(np.int64)
    raw = np.frombuffer(payload, np.uint8, offset=at + 8 * lanes)
    raw = np.concatenate([raw, np.zeros(step * 4 + 8, np.uint8)]).astype(np.uint64)
    window = raw[:-4] << np.uint64(32) | raw[1:-3] << np.uint64(24) | raw[2:-2] << np.uint64(16) \
        | raw[3:-1] << np.uint64(8) | raw[4:]
    out = np.empty((step, lanes), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(step):
        value = (window[place >> 3] >> (40 - bits - (place & 7)).astype(np.uint64)) & mask
        out[k] = symbol[value]
        place += size[value]
    return out.T.reshape(-1)[:n], docs


def _tokenise(path: str, end_id: int):
    def run(batches):
        sub = open_subwords(path)
        kind = np.uint16 if max(sub.vocab, end_id + 1) <= 1 << 16 else np.uint32
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids, docs, n = [], [], 0

        def row():
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_tokens": pa.array([n], pa.int64()),
                "docs": pa.array([np.array(docs, _DOC).tobytes()], pa.binary()),
                "ids": pa.array([np.concatenate(ids).tobytes()], pa.binary())})

        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = np.concatenate([[0], np.cumsum(batch.column(2).fill_null(0).to_numpy(zero_copy_only=False))])
            for i, j in document_runs(sizes, TEXT_RUN):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                flat, counts = sub.encode(texts)
                flat = np.insert(flat, np.cumsum(counts), end_id).astype(kind)
                at = 0
                for name, size in zip(names[i:j], (counts + 1).tolist()):
                    ids.append(flat[at:at + size])
                    docs.append((name or 0, name is not None, size))
                    at, n = at + size, n + size
                    if n >= BLOCK:
                        yield row()
                        block, first, ids, docs, n = block + 1, first + n, [], [], 0
        if docs:
            yield row()
    return run


def _id_array(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint16 if len(blob) == 2 * n else np.uint32)


def _count_ids(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for blob, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = np.bincount(_id_array(blob, n))
            if len(c) > len(total):
                c[:len(total)] += total
                total = c
            else:
                total[:len(c)] += c
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "n": total[used].astype(np.int64)})


def _encode(shared):
    def run(batches):
        lengths = shared.value
        codes = canonical_codes(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                n = one.column(3)[0].as_py()
                payload = encode_block(_id_array(one.column(5)[0].as_py(), n), one.column(4)[0].as_py(), codes, lengths)
                yield pa.RecordBatch.from_arrays(one.columns[:4] + [pa.array([payload], pa.binary())],
                                                 ["shard", "block", "first", "n_tokens", "payload"])
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text",
                 max_bits: int = MAX_BITS) -> None:
    """Encode every whole text, append ``end_id`` to each, and write the files under ``out``."""
    spark = docs.sparkSession
    one = columns(docs, id, text).select(
        F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    one = one.withColumn("size", F.octet_length("text")).withColumn("tie", F.xxhash64("text"))
    # the text's hash splits an id that very many rows share, and orders its rows
    ordered = one.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie", "text")
    parts = staged(ordered.select("doc", "text", "size").transform(map_arrow, _tokenise(tokenizer, end_id), _STAGE), "ids")
    # one row per id of the vocabulary at most
    counts = parts.select("ids", "n_tokens").transform(map_arrow, _count_ids, "id long, n long", 1) \
        .groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(max(counts.column("id").to_pylist(), default=end_id) + 1, np.int64)
    total[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    lengths = code_lengths(total, max_bits)
    shared = spark.sparkContext.broadcast(lengths)
    (parts.transform(map_arrow, _encode(shared), _BLOCKS, 1).write.option("compression", "none").parquet(f"{out}/blocks"))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1) \
        .write.parquet(f"{out}/codes")


def _read(shared):
    def run(batches):
        symbol, size, bits = decode_table(shared.value)
        for batch in batches:
            for shard, first, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids, docs = decode_block(payload, symbol, size, bits)
                yield shard, first, ids, docs
    return run


def read_documents(spark: SparkSession, out: str, id: str = "doc_id", ids: bool = False) -> DataFrame:
    """Per document of the files: ``id``, start (ids of all documents before it), n_tokens, ids_crc32.

    With ``ids`` also the decoded ids as an array. Only the files under ``out`` are read.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{out}/blocks")
    lengths = np.frombuffer(bytes(spark.read.schema("lengths binary").parquet(f"{out}/codes").first()[0]), np.uint8)
    shared = spark.sparkContext.broadcast(lengths)
    # one long per shard (a task of the writer)
    shards = sorted((r[0], r[1]) for r in blocks.groupBy("shard").agg(F.sum("n_tokens")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in shards])]).astype(np.int64).tolist()
    starts = spark.sparkContext.broadcast({s: b for (s, _), b in zip(shards, before)})
    schema = "doc long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def rows(batches):
        for shard, first, flat, docs in _read(shared)(batches):
            ends = np.cumsum(docs["n"])
            start = ends - docs["n"]
            raw = memoryview(flat.astype("<u4").tobytes())
            data = {
                "doc": pa.array(docs["doc"].astype(np.int64), mask=docs["known"] == 0),
                "start": start + first + starts.value[shard], "n_tokens": docs["n"].astype(np.int64),
                "ids_crc32": np.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(start.tolist(), ends.tolist())],
                                      np.int64)}
            if ids:
                data["ids"] = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(data)

    return blocks.select("shard", "first", "payload").transform(map_arrow, rows, schema, 1).withColumnRenamed("doc", id)
