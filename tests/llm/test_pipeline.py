"""The stages by brute force on the driver's smallest table."""

import pytest

import corpus_pipeline
from airlens.llm import quality, tiling
from airlens.llm.queries import QUERIES, table
from airlens.llm.shared import staged
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_SMALL), "stage")
        out.append(docs)
    return out


def test_stages(spark, stages):
    raw = table(spark, SF_SMALL, "documents")
    kept = [d.collect() for d in stages]
    for d in stages[:3]:
        assert d.columns == raw.columns
    trees = quality.fit_quality(raw, table(spark, SF_SMALL, "labels"))
    good = {r.doc_id for r in quality.score_quality(raw, trees).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept[0]} == good
    classes = {d: c for d, _, c in brute([(r.doc_id, r.text) for r in kept[0]])}
    assert sorted(r.doc_id for r in kept[1]) == sorted(d for d, c in classes.items() if d == c)
    leaks = {r.doc_id for r in tiling.benchmark_matches(stages[1], table(spark, SF_SMALL, "benchmark")).collect()}
    assert sorted(r.doc_id for r in kept[2]) == sorted(r.doc_id for r in kept[1] if r.doc_id not in leaks)
    assert {r.doc_id for r in kept[3]} == {r.doc_id for r in kept[2]}
    assert sum(r.length for r in kept[3]) > 0


def test_near_copies_of_odd_rows(spark, docs, rows):
    got = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL)
    classes = brute(rows)
    want = {d for d, n, c in classes if d == c}
    assert got.dtypes == docs.dtypes and {r.doc_id for r in got.collect()} >= want - {None}
    texts = [(r.doc_id, r.text) for r in got.collect()]
    assert len(texts) == len(set(texts))


def test_rows_are_told_apart_by_id_and_text(spark):
    """A repeated id keeps its unique text; of near copies without an id one stays at most."""
    text, other, third = (" ".join(f"{x}{i}" for i in range(60)) for x in "wvu")
    rows = [(1, text), (5, text + " end"), (5, other), (5, other), (None, "start " + text), (None, third), (None, third + " end"),
            (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL).collect()]
    assert len(got) == 4 and {(1, text), (5, other), (None, "")} < set(got)
    assert len({(None, third), (None, third + " end")} & set(got)) == 1


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got.collect()) == \
        sorted((r.doc_id, r.piece, r.ids_crc32) for r in stages[3].collect())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
