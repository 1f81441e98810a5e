import numpy as np
import pyarrow as pa

from airlens.llm import quality


def test_statistics_of_odd_texts():
    x = quality.statistics(pa.array([None, "", " \n", "a", "A b. A b.\nA b.", "é" * 10]))
    assert x.shape == (6, len(quality.STATISTICS)) and np.isfinite(x).all()
    assert (x[0] == 0).all() and (x[1] == 0).all()
    s = dict(zip(quality.STATISTICS, x[4]))
    assert s["share_upper"] == 3 / 14 and s["share_newline"] == 1 / 14
    assert s["distinct_words"] == 2 / 6 and abs(s["distinct_lines"] - 1) < 1e-9
    assert dict(zip(quality.STATISTICS, x[5]))["share_accent"] == 0.5


def test_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality.fit_trees(x[:2000], y[:2000])
    p = trees.score(x[2000:])
    assert ((p >= 0.5) == y[2000:]).mean() > 0.97 and p.min() >= 0 and p.max() <= 1


def walk(trees, row):
    total = trees.base
    for node in trees.roots.tolist():
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_arrays_score_like_a_walk():
    r = np.random.default_rng(1)
    x = r.random((300, 5))
    trees = quality.fit_trees(x, (x.sum(1) > 2.5).astype(float))
    assert np.allclose(trees.score(x[:50]), [walk(trees, row) for row in x[:50]])


def test_one_label_or_none():
    x = np.random.default_rng(2).random((10, 3))
    assert quality.fit_trees(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 10
    assert (quality.fit_trees(x, np.ones(10)).score(x) > 0.9).all()


def test_score_and_keep(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(3, None, 1), (None, 1, 0), (999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    trees = quality.fit_quality(docs, labels)
    scored = quality.score_quality(docs, trees)
    got = scored.collect()
    assert len(got) == len(rows) and scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out is not None for r in got)
    kept = quality.keep_good(docs, trees)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)
    empty = quality.fit_quality(no_docs, labels)
    assert quality.score_quality(no_docs, empty).count() == 0
    assert {r.score for r in quality.score_quality(docs, empty).collect()} == {0.5}


def test_held_out_accuracy(spark):
    """On the driver's table the score must carry over to documents it did not see."""
    from airlens.llm.queries import op2_quality_classifier, table
    from tests.conftest import SF_CHECK
    got = op2_quality_classifier(spark, SF_CHECK).join(table(spark, SF_CHECK, "labels"), "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) > 0.97
