"""Fill in the middle: against plain slicing of Python strings, exact way back, very long texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airlens.llm import infill
from tests.llm.conftest import prose


def by_hand(id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_equals_plain_slicing(spark, docs, rows):
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    seen = sorted(((r.doc_id, r.back, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got), key=repr)
    assert seen == sorted(((i, t or "", by_hand(i, t)) for i, t in rows), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_marks_and_near_marks(spark):
    texts = ["a<P>b", "<", "<S", "S>", "a<<S", "<P<M", "><M", "<S<S<S", "P>S>M>", "<M>", "\n$1\\E<P", "🦊é\0x"]
    rows = [(1000 * k + j, t) for k in range(30) for j, t in enumerate(texts)]
    out = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in out.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()}
    for i, t in rows:
        assert got[i].back == t
        assert (got[i].n, got[i].form, got[i].prefix_chars, got[i].middle_chars, got[i].output) == by_hand(i, t)


def test_empty_table(no_docs):
    out = infill.fill_in_middle(no_docs)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert out.count() == 0


@pytest.mark.parametrize("limit", [1, 5, 64, 1 << 19])
def test_runs_of_any_size_give_the_same_parts(limit):
    rnd = random.Random(limit)
    texts = ["", "é", "🦊🦊🦊", prose(rnd, 60), "ü" * 301, "", "ab", "漢字かな" * 40]
    sizes = np.array([len(t) for t in texts])
    for _ in range(10):
        a = np.array([rnd.randint(0, n) for n in sizes])
        b = np.array([rnd.randint(x, n) for x, n in zip(a, sizes)])
        got = infill.cut_texts(pa.array(texts), a, b, limit)
        want = [[t[:x] for t, x in zip(texts, a)], [t[x:y] for t, x, y in zip(texts, a, b)], [t[y:] for t, y in zip(texts, b)]]
        assert [g.to_pylist() for g in got] == want


def test_very_long_text(spark):
    text = "naïve 🦊 text, " * 200_000
    out = infill.fill_in_middle(spark.createDataFrame([(7, text), (8, text[:-1])], "doc_id long, text string"))
    for r in out.collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, text if r.doc_id == 7 else text[:-1])
