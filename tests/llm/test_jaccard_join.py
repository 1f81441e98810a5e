import numpy as np
import pyarrow as pa
import pytest

from airlens.llm import jaccard_join
from airlens.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def brute(rows):
    """(id, set size, least id of the class) per row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids and sets[i] else doc))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [32, 3])
def test_equals_all_pairs(docs, rows, monkeypatch, heavy):
    """With a small bound most shingles count as frequent and the hub rounds do the work."""
    monkeypatch.setattr(jaccard_join, "HEAVY", heavy)
    got = sorted((tuple(r) for r in jaccard_join.jaccard_classes(docs).collect()), key=str)
    assert got == brute(rows)


def test_near_copies_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(7, text), (None, text + " end"), (None, "start " + text), (None, other), (None, other + " end"), (9, "a b c d e f")]
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_no_task_gets_all_copies(monkeypatch):
    """Records of documents are in rows of bounded size outside the buckets, however many share a group."""
    class Shared:
        value = np.zeros(1, np.uint64), np.zeros(1, np.int64)

    monkeypatch.setattr(jaccard_join, "MEMBERS", 16)
    texts = ["one two three four five six seven"] * 100 + [None] * 60
    batch = pa.RecordBatch.from_pydict({"doc": list(range(160)), "text": pa.array(texts, pa.string()), "tie": [0] * 160})
    out = [r for b in jaccard_join._prefix_lists(8, 75, Shared)([batch]) for r in b.to_pylist()]
    own = [r for r in out if r["extra"] is not None]
    assert own and all(r["bucket"] is None and int.from_bytes(r["counts"], "little") <= 16 for r in own)
    rows = pa.RecordBatch.from_pylist([{k: r[k] for k in ("extra", "counts", "maps")} for r in own],
                                      pa.schema([(k, pa.binary()) for k in ("extra", "counts", "maps")]))
    back = [r for b in jaccard_join._records([rows]) for r in b.to_pylist()]
    assert [r["doc"] for r in back] == list(range(160)) and [r["n"] for r in back] == [3] * 100 + [0] * 60


def test_pairs_of_a_long_run_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART", 5)
    rows = spark.createDataFrame([(run, k, a, 1, a, a) for run, k in ((1, 40), (2, 3)) for a in range(k)],
                                 "run long, k long, a long, n long, la long, xa long")
    got = jaccard_join._all_pairs(rows).select("run", "p", "q", "a", "b").collect()
    assert sorted((r.run, min(r.a, r.b), max(r.a, r.b)) for r in got) == \
        sorted((run, a, b) for run, k in ((1, 40), (2, 3)) for b in range(k) for a in range(b))
    assert len({(r.p, r.q) for r in got if r.run == 1}) > 20


def test_empty_table(no_docs):
    assert jaccard_join.jaccard_classes(no_docs).count() == 0


def test_packing_of_sorted_numbers():
    x = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1000).astype(np.uint64))
    assert (jaccard_join._unpack(jaccard_join._pack(x, 6), 6) == x).all()


def test_parity_maps_never_rule_out_a_link():
    r = np.random.default_rng(2)
    for n in (1, 5, 60, 700, 3000):
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(0.86 * len(a)) + 1], r.integers(0, 1 << 63, n // 8).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        ones = [np.unpackbits(np.frombuffer(jaccard_join._parity(s, 512), np.uint8)) for s in (a, b)]
        assert (ones[0] ^ ones[1]).sum() * 175 <= 25 * (len(a) + len(b))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (102, 100)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
