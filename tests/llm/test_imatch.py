import hashlib
import re
from collections import Counter

from airlens.llm import imatch


def words(text):
    return {w.decode() for w in (text or "").encode().lower().split()}


def expected(rows):
    """(id, n_chars, sha of the edited text, own text, edited text, next text) in order."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    ties = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").distinct()
            .selectExpr("t", "xxhash64(t) h").collect()}
    order = sorted(((d is not None, d or 0), ties[t or ""], t or "", d) for d, t in rows)
    out = []
    for k, (_, _, text, d) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


def test_fingerprints(docs, rows):
    got = imatch.fingerprints(docs).collect()
    want = expected(rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted((str(w[0]), w[1], w[2]) for w in want)
    of = {}
    texts = {(str(w[0]), w[1], w[2]): w for w in want}
    df = Counter(w for _, t in rows for w in words(t))
    band = {w for w, n in df.items() if 2 <= n <= max(2, len(rows) / 20)}
    for r in got:
        w = texts[str(r.doc_id), r.n_chars, r.edited_sha256]
        for text, print_ in ((w[3], r.fingerprint), (w[4], r.edited_fingerprint)):
            assert of.setdefault(text, print_) == print_          # equal texts, equal fingerprints
            assert print_.startswith("text:") == (not words(text) & band)
            assert print_.startswith("text:") or re.fullmatch("(:?[0-9A-F]{16}){15}", print_)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) >= (w[3] == w[4]) and (r.near_next == 1) >= (w[3] == w[5])
    # the same lexicon terms and nothing else decide: an equal band gives an equal fingerprint
    by_band = {}
    for text, print_ in of.items():
        own = frozenset(words(text) & band)
        if own:
            assert by_band.setdefault(own, print_) == print_


def test_main_path_has_no_python(docs):
    plan = imatch.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_single(spark, no_docs):
    assert imatch.fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(9, "Abcd efgh")], "doc_id long, text string")
    r = imatch.fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"Abcd Abcd").hexdigest() and r.near_next == 1


def test_range_buckets(spark):
    bounds = [3, 7, 8, 20, 100]
    rows = spark.createDataFrame([(i,) for i in [-5, 0, 3, 4, 7, 8, 9, 20, 21, 100, 101, 10 ** 12]], "v long")
    for r in rows.withColumn("b", imatch._range_bucket(rows.v, bounds)).collect():
        assert r.b == sum(x < r.v for x in bounds)
