import random

import numpy as np
import pyarrow as pa
import pytest

from airlens.llm import tiling
from airlens.llm.words import documents


def brute_tiles(a, b, least):
    """The definition: take the longest common stretch of free words, first by place, until none is left."""
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        free_a[i:i + n] = [False] * n
        free_b[j:j + n] = [False] * n


def test_tiles_equal_the_definition():
    rnd = random.Random(1)
    for _ in range(150):
        a = np.array([rnd.randrange(4) for _ in range(rnd.randint(0, 25))], np.uint64)
        b = np.array([rnd.randrange(4) for _ in range(rnd.randint(0, 25))], np.uint64)
        assert tiling.greedy_tiles(a, b, 3) == brute_tiles(a.tolist(), b.tolist(), 3)


def hashes(text):
    return next(documents(pa.array([text])))[1]


ITEM = " ".join(f"q{i}" for i in range(30)) + "."


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM, "x"), (2, "too short an item", None), (3, None, None), (4, "", None), (5, ITEM, "again"),
            (None, " ".join(f"z{i}" for i in range(12)), None)]
    return spark.createDataFrame(rows, "item_id long, text string, tiles string")


def test_matches(spark, docs, bench, no_docs):
    words = ITEM.split()
    turned = " ".join(words[20:] + ["and"] + words[10:20] + ["then"] + words[:10])
    half = "begin " + " ".join(words[:15]) + " end"
    added = [(500, f"Some text. {ITEM} More.", *["x"] * 9), (501, turned.upper(), *["x"] * 9), (502, half, *["x"] * 9),
             (None, " ".join(f"z{i}" for i in range(12)), *["x"] * 9)]
    more = docs.union(spark.createDataFrame(
        [(i, t, None, None, 1, "d", "n", "b", "t", "c", "x") for i, t, *_ in added], docs.schema))
    got = {(r.doc_id, r.item_id): r for r in tiling.benchmark_matches(more, bench).collect()}
    assert set(got) == {(500, 1), (500, 5), (501, 1), (501, 5), (None, None)}
    assert got[500, 1].coverage == 1 and len(got[500, 1].tiles) == 1 and got[500, 1].tiles[0].doc_word == 2
    assert got[501, 1].covered_words == 30 and len(got[501, 1].tiles) == 3
    kept = tiling.without_benchmark(more, bench)
    assert kept.schema == more.schema and kept.count() == more.count() - 3
    assert tiling.benchmark_matches(no_docs, bench).count() == 0
    assert tiling.benchmark_matches(docs, bench.limit(0)).count() == 0
    assert tiling.without_benchmark(docs, bench.limit(0)).count() == docs.count()


def test_blocks_of_items_change_nothing(docs, spark, monkeypatch, rows):
    bench = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows[:40])], "item_id long, text string")
    whole = sorted((str(r.doc_id), r.item_id, r.covered_words) for r in tiling.benchmark_matches(docs, bench).collect())
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 2000)
    parts = sorted((str(r.doc_id), r.item_id, r.covered_words) for r in tiling.benchmark_matches(docs, bench).collect())
    assert whole == parts and whole
    # every pair of texts, by the definition
    want = []
    for d, t in rows:
        for k, (_, item) in enumerate(rows[:40]):
            a, b = hashes(item), hashes(t) if t else np.empty(0, np.uint64)
            if len(a) >= 5 and len(b) < 200:
                covered = sum(x[2] for x in tiling.greedy_tiles(a, b, 5))
                if covered >= tiling.THRESHOLD * len(a):
                    want.append((str(d), k, covered))
    long = {str(d) for d, t in rows if t and len(t.split()) >= 200}
    assert [x for x in whole if x[0] not in long] == sorted(want)
