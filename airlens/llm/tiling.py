"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, ``least`` words in a row,
are tiled: the longest stretch of words that both hold and no tile covers yet
becomes a tile, again and again, until none of ``least`` words is left.
Stretches are found by running Karp-Rabin hashes. A pair is reported if its
tiles cover at least ``threshold`` of the item's words, in whatever order they
stand in the document, so reordered passages count.

Words are as in ``words``: runs of bytes other than ASCII white space, A-Z
lower-cased. Null and empty texts and items of fewer than ``least`` words match
nothing. Repeated documents or items are each reported; null ids stay null; other columns are
ignored. Items are broadcast in blocks of about ``BLOCK_BYTES`` of text, each
held against all documents, so the broadcast is bounded for any benchmark.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, map_arrow
from airlens.llm.words import U64, _powers, documents, gram_hashes

LEAST = 5
THRESHOLD = 0.6
BLOCK_BYTES = 8 << 20
_CELLS = 22       # bits of the table that rules out most words at once
_STEP = 0xD6E8FEB86659FD93

_PAIRS = ("doc long, item long, item_words long, covered_words long, coverage double, "
          "tiles array<struct<doc_word:long,item_word:long,length:long>>")


def _windows(x: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and running hashes of all stretches of ``size`` words that no tile touches."""
    n = len(x)
    if n < size:
        return np.empty(0, np.int64), np.empty(0, U64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[:-size])
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(x * _powers(_STEP, n))])
        down = _powers(pow(_STEP, -1, 1 << 64), n)
        return at, (total[at + size] - total[at]) * down[at]


def _length(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, i: int, j: int) -> int:
    """Words from a[i] and b[j] on that agree and no tile covers."""
    n = min(len(a) - i, len(b) - j)
    stop = (a[i:i + n] != b[j:j + n]) | ~free_a[i:i + n] | ~free_b[j:j + n]
    return int(np.argmax(stop)) if stop.any() else n


def greedy_tiles(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in a, place in b, words): longest first, then by place; none touches another in a or b."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(a), len(b)))
    while True:
        at_a, hash_a = _windows(a, free_a, size)
        at_b, hash_b = _windows(b, free_b, size)
        order = np.argsort(hash_b, kind="stable")
        low = np.searchsorted(hash_b[order], hash_a, "left")
        high = np.searchsorted(hash_b[order], hash_a, "right")
        found = []
        for i, p, q in zip(at_a.tolist(), low.tolist(), high.tolist()):
            for j in at_b[order[p:q]].tolist():
                before = i and j and a[i - 1] == b[j - 1] and free_a[i - 1] and free_b[j - 1]
                if before:
                    continue          # inside a longer stretch that starts earlier
                n = _length(a, b, free_a, free_b, i, j)
                if n >= size:
                    found.append((-n, i, j))
        heapq.heapify(found)
        while found:
            n, i, j = heapq.heappop(found)
            n = -n
            clear = np.flatnonzero(free_a[i:i + n] & free_b[j:j + n])
            if len(clear) < n:        # a tile took a part: what is left of the stretch waits in its turn
                for run in np.split(clear, np.flatnonzero(np.diff(clear) > 1) + 1):
                    if len(run) >= size:
                        heapq.heappush(found, (-len(run), i + int(run[0]), j + int(run[0])))
                continue
            tiles.append((i, j, n))
            free_a[i:i + n] = free_b[j:j + n] = False
        if size == least:
            return tiles
        size = max(least, size // 2)


@dataclass
class Items:
    """A block of benchmark items as word hashes, and its seeds sorted by hash."""
    ids: list
    words: list[np.ndarray]
    seed: np.ndarray
    first: np.ndarray
    item: np.ndarray
    cells: np.ndarray


def items_of(ids: list, texts: pa.Array, least: int) -> Items:
    words = []
    for _, h, bounds in documents(texts):
        words += [h[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:])]
    grams = [gram_hashes(w, least) for w in words]
    seed = np.concatenate([np.empty(0, U64), *grams])
    item = np.repeat(np.arange(len(words)), [len(g) for g in grams])
    pairs = np.unique(np.rec.fromarrays([seed, item], names="seed,item"))
    cells = np.zeros(1 << _CELLS, bool)
    cells[(seed >> U64(64 - _CELLS)).astype(np.int64)] = True
    unique, first = np.unique(pairs["seed"], return_index=True)
    return Items(ids, words, unique, np.append(first, len(pairs)), pairs["item"], cells)


def _covered(places: np.ndarray, least: int) -> np.ndarray:
    """Places that a seed from one of ``places`` covers, sorted."""
    return np.unique((places[:, None] + np.arange(least)).ravel())


def matches(words: np.ndarray, grams: np.ndarray, items: Items, least: int, threshold: float):
    """(item number, covered words, tiles) of the items that a document covers enough of."""
    if not len(items.seed) or not len(grams):
        return
    place = np.flatnonzero(items.cells[(grams >> U64(64 - _CELLS)).astype(np.int64)])
    if not len(place):
        return
    at = np.minimum(np.searchsorted(items.seed, grams[place]), len(items.seed) - 1)
    hit = items.seed[at] == grams[place]
    place, at = place[hit], at[hit]
    if not len(place):
        return
    times = items.first[at + 1] - items.first[at]
    doc_place = np.repeat(place, times)
    item = items.item[np.repeat(items.first[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())]
    order = np.lexsort((doc_place, item))
    item, doc_place = item[order], doc_place[order]
    edge = np.append(np.flatnonzero(np.append(True, item[1:] != item[:-1])), len(item))
    for a, b in zip(edge[:-1], edge[1:]):
        k = int(item[a])
        of = items.words[k]
        shared = np.isin(gram_hashes(of, least), grams[doc_place[a:b]])
        if len(_covered(np.flatnonzero(shared), least)) < threshold * len(of):
            continue                  # even all its shared words are too few
        spots = _covered(doc_place[a:b], least)
        # only stretches that seeds cover can hold tiles; a gap becomes one word that occurs nowhere else
        gap = np.flatnonzero(np.diff(spots) > 1) + 1
        text = np.insert(words[spots], gap, np.arange(len(gap), dtype=U64))
        origin = np.insert(spots, gap, -1)
        tiles = [(int(origin[j]), i, n) for i, j, n in greedy_tiles(of, text, least)]
        covered = sum(t[2] for t in tiles)
        if covered >= threshold * len(of):
            yield k, covered, tiles


def _blocks(benchmark: DataFrame, id: str, text: str, least: int):
    """The benchmark as broadcastable blocks, one after another."""
    one = columns(benchmark, id, text).select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")) \
        .where("text is not null")
    size = one.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        part = one.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toArrow().combine_chunks()
        if part.num_rows:
            column = part.column("text").combine_chunks().cast(pa.string())
            yield items_of(part.column("id").to_pylist(), column, least)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", least: int = LEAST,
                      threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item whose tiles cover at least ``threshold`` of the item.

    Columns: ``id``, ``item_id``, item_words, covered_words, coverage, tiles
    (first word in the document, first word in the item, words).
    """
    spark = docs.sparkSession
    one = columns(docs, id, text).select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    found = spark.createDataFrame([], _PAIRS)
    for items in _blocks(benchmark, item_id, item_text, least):
        shared = spark.sparkContext.broadcast(items)

        def rows(batches, shared=shared):
            block = shared.value
            for batch in batches:
                ids, out = batch.column(0).to_pylist(), []
                for first, h, bounds in documents(batch.column(1)):
                    grams = gram_hashes(h, least)
                    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                        for item, covered, tiles in matches(h[a:b], grams[a:max(a, b - least + 1)], block, least, threshold):
                            n = len(block.words[item])
                            out.append({"doc": ids[first + k], "item": block.ids[item], "item_words": n,
                                        "covered_words": covered, "coverage": covered / n, "tiles": [
                                            {"doc_word": p, "item_word": q, "length": m} for p, q, m in tiles]})
                if out:
                    yield pa.RecordBatch.from_pylist(out, _arrow_pairs())

        found = found.unionAll(one.transform(map_arrow, rows, _PAIRS))
    return found.withColumnRenamed("doc", id).withColumnRenamed("item", item_id)


def _arrow_pairs() -> pa.Schema:
    tile = pa.struct([(c, pa.int64()) for c in ("doc_word", "item_word", "length")])
    return pa.schema([("doc", pa.int64()), ("item", pa.int64()), ("item_words", pa.int64()),
                      ("covered_words", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(tile))])


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that cover no item enough, with all their columns."""
    at = docs.columns.index(text)
    for items in _blocks(benchmark, item_id, item_text, least):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def rows(batches, shared=shared):
            for batch in batches:
                clean = []
                for _, h, bounds in documents(batch.column(at)):
                    grams = gram_hashes(h, least)
                    clean += [next(matches(h[a:b], grams[a:max(a, b - least + 1)], shared.value, least, threshold),
                                   None) is None for a, b in zip(bounds[:-1], bounds[1:])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.transform(map_arrow, rows, docs.schema)
    return docs
