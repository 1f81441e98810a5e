import math
import zlib
from collections import Counter

import numpy as np
import pytest

from airlens.llm import attention_lm as L
from airlens.llm.queries import tokenizer

WORD = tokenizer("word_bpe_49k.json")


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def test_base_scores_and_counts(docs, rows, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 3000)         # several chunks: counts must meet across them
    got = L.score_texts(docs, WORD).collect()
    tokens = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    c = Counter(w for (d, _), ws in zip(rows, tokens) if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for (d, _), ws in zip(rows, tokens))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_empty_and_untrained(spark, no_docs):
    assert L.score_texts(no_docs, WORD).count() == 0
    only_held = spark.createDataFrame([(i, "a b c") for i in range(60) if held(i)], "doc_id long, text string")
    got = L.score_texts(only_held, WORD).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)


@pytest.fixture(scope="module")
def model():
    r = np.random.default_rng(0)
    n = 3000
    counts = r.integers(0, 50, n)
    rank_of = L._ranks(counts)
    table = r.integers(0, 30, (L.RANKS + 1, L.RANKS + 1)).astype(float)
    m = L._tables(counts, rank_of, table)
    m["out"] = r.standard_normal(m["out"].shape).astype(np.float32) * 0.3
    m["near"] = r.standard_normal(m["near"].shape).astype(np.float32)
    return m, n


def slow(m, before, target, doc):
    """One id at a time: the ids it may see, one softmax over them, one over the classes."""
    out = []
    ids = m["rank_of"][before]
    for t in range(len(target)):
        low = max(0, t // L.STRIDE * L.STRIDE - L.STRIDE)
        seen = [s for s in range(low, t + 1) if doc[s] == doc[t]]
        e = m["embedding"][ids]
        a = np.array([(e[t] @ m["query"]) @ (e[s] @ m["key"]) * L.WIDTH ** -0.5 + m["near"][t - s] for s in seen])
        a = np.exp(a - a.max())
        read = sum(w * (e[s] @ m["value"]) for w, s in zip(a / a.sum(), seen))
        z = m["rows"][ids[t]] + read @ m["out"] + m["bias"]
        k = m["rank_of"][target[t]]
        p = z[m["class_of"][k]] - np.log(np.exp(z).sum()) + m["within"][ids[t], k]
        out.append((p + (m["rest"][target[t]] if k == L.RANKS else 0)) / np.log(10))
    return out


def test_windows_equal_one_id_at_a_time(model):
    m, n = model
    r = np.random.default_rng(1)
    target = r.integers(0, n, 150)
    before = np.append(n - 1, target[:-1])
    doc = np.repeat([0, 1, 2, 3], [40, 1, 70, 39])
    assert np.allclose(L.log10_probabilities(m, before, target, doc), slow(m, before, target, doc), atol=1e-4)


def test_probabilities_sum_to_one(model):
    m, n = model
    doc = np.zeros(20, np.int64)
    head = np.random.default_rng(2).integers(0, n, 20)
    total = 0.0
    for k in range(n):
        target = head.copy()
        target[-1] = k
        total += 10 ** L.log10_probabilities(m, np.append(n - 1, head[:-1]), target, doc)[-1]
    assert abs(total - 1) < 1e-3


def test_gradients(model):
    """Training lowers the loss of a sequence with a pattern that needs the ids before the last."""
    m, n = model
    r = np.random.default_rng(3)
    x = r.integers(0, 40, 8000)
    x[2::3] = x[0:-2:3]
    top = np.argsort(m["rank_of"])[:40]
    target = top[x]
    before = np.append(n - 1, target[:-1])
    doc = np.zeros(len(x), np.int64)
    loss = -L.log10_probabilities(m, before, target, doc).mean()
    for _ in range(3):
        got, weight = L._train(m, before, target, doc)
        m = m | got
    assert weight == L.STEPS * L.BATCH
    assert -L.log10_probabilities(m, before, target, doc).mean() < loss - 0.05


def test_a_step_goes_against_the_gradient_of_the_loss(model, monkeypatch):
    """Adam's first step moves every weight by RATE; the loss must fall along each, as finite differences tell."""
    m, n = model
    monkeypatch.setattr(L, "STEPS", 1)
    monkeypatch.setattr(L, "ROUNDS", 1)
    r = np.random.default_rng(4)
    target = np.argsort(m["rank_of"])[r.integers(0, 300, (L.BATCH + 1) * L.STRIDE)]
    before = np.append(n - 1, target[:-1])
    doc = np.sort(r.integers(0, 9, len(target)))
    got, weight = L._train(m, before, target, doc)
    assert weight == L.BATCH
    tried = 0
    for name in L.TRAINED:
        step = got[name] - m[name]
        assert np.abs(step).max() <= L.RATE * 1.01
        for at in r.choice(step.size, min(step.size, 40), replace=False):
            loss = []
            for way in (0.05, -0.05):
                x = m[name].copy()
                x.flat[at] += way
                loss.append(-L.log10_probabilities(m | {name: x}, before, target, doc)[L.STRIDE:].mean())
            if abs(loss[0] - loss[1]) > 2e-6:
                tried += 1
                assert (loss[0] > loss[1]) == (step.flat[at] < 0), name
    assert tried > 60


def test_large_scores_stay_finite_in_training(model):
    """A sum of class scores beyond float32 is taken again less the largest score."""
    m, n = model
    target = np.argsort(m["rank_of"])[np.random.default_rng(6).integers(0, 300, 2000)]
    got, _ = L._train(m | {"bias": m["bias"] + np.float32(200)}, np.append(n - 1, target[:-1]), target, np.zeros(2000, np.int64))
    assert all(np.isfinite(got[k]).all() for k in L.TRAINED)


def test_words_are_split_and_numbered_in_one_go():
    """Arrow's words are those of bytes.split(); nothing is done word by word."""
    texts = ["", " ", " A\tb\x0b\x0cC\r\nd ", "É\u3000x\x1cy\x85Z\u00a0q", "\x00 a", "one", "  two"]
    words, n = L._split(L.pa.array(texts))
    want = [t.encode().lower().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for x in want for w in x] and n.tolist() == [len(x) for x in want]
    assert L._split(L.pa.array(["", "  "]))[1].tolist() == [0, 0]


@pytest.mark.parametrize("n", [1, 5, 499, 3000, 50_001])
def test_rounds_train_on_all_windows(n):
    rounds = [L._windows(n, turn) for turn in range(L.ROUNDS)]
    assert set(np.concatenate(rounds).tolist()) == set(range(n))
    assert all(len(x) == max(-(-n // L.ROUNDS), min(4 * n, L.STEPS * L.BATCH)) for x in rounds)


def test_chunks_count_by_their_windows(model):
    m, n = model
    for ids in (400, 40_000):
        docs = np.array([(1, True, False, ids)], L._DOC)
        row = [L._z(docs), L._z(np.zeros(ids, "<u4")), L._z(np.array([3], "<u4")), L._z(np.array([1], "<u4"))]
        batch = L.pa.RecordBatch.from_arrays([L.pa.array([x], L.pa.binary()) for x in row], ["docs", "index", "sub", "lengths"])

        class Shared:
            value = m

        out = next(L._train_chunks(Shared, n, 1)([batch]))
        assert out.column("w")[0].as_py() == (ids + 1) // L.STRIDE - 1


def test_beats_the_base_on_held_out_texts(spark):
    from airlens.llm.queries import op4_attention_lm
    got = op4_attention_lm(spark, "/root/testdata/sf0.1").where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got.s > got.b
