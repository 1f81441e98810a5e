"""Whitening: secular equation, updates and merges against dense eigenproblems; the operator against plain numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airlens.llm import whitening
from airlens.llm.queries import op13_embedding_whitening, table
from airlens.llm.whitening import Spectrum
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, dims string, part string"


def scatter(rows):
    c = rows - rows.mean(0)
    return c.T @ c


def rebuilt(s):
    return (s.vectors * s.values) @ s.vectors.T


def right_angles(s):
    return np.abs(s.vectors.T @ s.vectors - np.eye(len(s.values))).max(initial=0)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 30), st.sampled_from([1e-9, 1e-3, 1.0, 1e6]), st.sampled_from([0, 1, 6]))
def test_update_of_diagonal(seed, k, rho, spread):
    rnd = np.random.default_rng(seed)
    d = np.sort(rnd.random(k) * 10.0 ** rnd.integers(-spread, spread + 1, k))
    d += np.arange(k) * 1e-6
    z = rnd.standard_normal(k) * 10.0 ** rnd.integers(-3, 1, k)
    z[np.abs(z) < 1e-4] = 1e-4
    values, vectors = whitening.update_of_diagonal(d, z, rho)
    want = np.diag(d) + rho * np.outer(z, z)
    size = np.abs(want).max()
    assert (values[:-1] <= d[1:]).all() and (values >= d).all()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs((vectors * values) @ vectors.T - want).max() < 1e-12 * size
    assert np.abs(values - np.linalg.eigvalsh(want)).max() < 1e-12 * size


def cases():
    rnd = np.random.default_rng(4)
    base = np.floor(rnd.standard_normal((300, 12)) * 20)
    yield "full", base
    yield "few rows", base[:5]
    yield "one row", base[:1]
    yield "equal rows", np.repeat(base[:1], 40, 0)
    yield "rank two", np.outer(base[:, 0], base[0]) + np.outer(base[:, 1], base[1])
    yield "repeated rows", np.repeat(base[:7], 30, 0)
    yield "constant dimensions", base * (np.arange(12) % 3 > 0)
    yield "equal eigenvalues", np.vstack([np.eye(12) * 5, -np.eye(12) * 5] * 3)
    yield "one dimension", base[:, :1]
    yield "far from zero", base + 1e6
    yield "uneven", base * 10.0 ** np.arange(-6, 6)


@pytest.mark.parametrize("name, rows", list(cases()))
def test_updates_and_merges(name, rows):
    want = scatter(rows)
    size = max(np.abs(want).max(), np.abs(rows).max() * 1e-6, 1e-12)
    one = Spectrum.empty(rows.shape[1])
    for r in rows:
        one.add(r)
    parts = []
    for piece in np.array_split(rows, 4):
        s = Spectrum.empty(rows.shape[1])
        for r in piece:
            s.add(r)
        parts.append(s)
    for s in parts[1:]:
        parts[0].merge(s)
    for s in (one, parts[0]):
        assert s.n == len(rows) and np.allclose(s.mean, rows.mean(0), rtol=1e-12, atol=1e-12)
        assert (np.diff(s.values) >= 0).all() and right_angles(s) < 1e-12
        assert np.abs(rebuilt(s) - want).max() < 1e-11 * size


def plain(rows):
    """The contract by plain numpy and whole numbers: id -> (deviation, whitened up to sign), explained, values."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(x) for _, x in good), default=0)
    good = [(i, x) for i, x in good if len(x) == dims]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in good:
        off = [n * a - s for a, s in zip(x, sums)]
        out.append((i, sum(o * o for o in off), np.array([o / n for o in off]) @ vectors / np.sqrt(np.maximum(values, 1e-300))))
    return out, n, values / values.sum(), values


def agree(got, rows, count=16):
    want, n, explained, values = plain(rows)
    k = min(count, len(values))
    assert len(got) == len(want) * k
    by_id = {}
    for r in got:
        assert r.n == n and abs(r.explained - explained[r.component - 1]) <= 1e-9 * explained[r.component - 1] and r.identity_error < 1e-9
        by_id.setdefault(r.vec_id, []).append(r)
    sign = [None] * k
    for i, deviation, white in want:
        mine = by_id[i]
        assert {r.deviation for r in mine if r.component == 1} >= {deviation}
        for c in range(k):
            found = [r.whitened for r in mine if r.component == c + 1 and r.deviation == deviation]
            if sign[c] is None and abs(white[c]) > 1e-3:
                sign[c] = np.sign(found[0] * white[c])
            assert any(abs(f - (sign[c] or 1) * white[c]) < 1e-8 for f in found)


def vectors(seed, n, dims):
    rnd = np.random.default_rng(seed)
    return [[float(c) for c in v] for v in (rnd.standard_normal((n, dims)) * np.linspace(2, 0.3, dims)).astype(np.float32)]


def test_rows(spark):
    v = vectors(1, 120, 20)
    rows = list(enumerate(v)) + [(i, v[3]) for i in range(200, 260)] + [(5, v[5]), (None, v[7])]      # copies, equal rows, no id
    bad = [(300, None), (301, []), (302, v[0][:-1]), (303, [None, *v[0][1:]]), (304, [float("nan"), *v[0][1:]]),
           (305, [float("-inf"), *v[0][1:]])]
    df = spark.createDataFrame([(i, x, 1, "a", "b", "c", "d") for i, x in rows + bad], SCHEMA).repartition(5)
    agree(whitening.whiten(df).collect(), rows)


def test_driver_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    agree(op13_embedding_whitening(spark, SF_SMALL).collect(), rows)


def test_few_dimensions_and_many_files(spark):
    rows = list(enumerate(vectors(2, 500, 3)))
    for parts in (1, 70):      # two levels of combined spectra
        df = spark.createDataFrame([(i, x, 1, "a", "b", "c", "d") for i, x in rows], SCHEMA).repartition(parts)
        got = whitening.whiten(df).collect()
        assert {r.component for r in got} == {1, 2, 3}
        agree(got, rows)


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25], 1, "a", "b", "c", "d") for i in range(4)], SCHEMA)
    got = whitening.whiten(same).collect()
    assert len(got) == 8 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, 0.0, 0.0)}
    flat = spark.createDataFrame([(i, [i / 2, 0.25], 1, "a", "b", "c", "d") for i in range(4)], SCHEMA)
    got = whitening.whiten(flat).collect()
    assert {r.whitened for r in got if r.component == 2} == {None} and {r.explained for r in got if r.component == 1} == {1.0}
    assert all(r.identity_error < 1e-12 for r in got)
    for rows in ([], [(1, None, 1, "a", "b", "c", "d")], [(1, [], 1, "a", "b", "c", "d")]):
        none = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and none.count() == 0


def test_huge_entries(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [0.0, 0.5])]
    got = whitening.whiten(spark.createDataFrame([(i, x, 1, "a", "b", "c", "d") for i, x in rows], SCHEMA)).collect()
    assert len(got) == 6 and {r.deviation is None for r in got if r.vec_id < 2} == {True}


def test_exact_sums_and_deviations():
    model = whitening.Whitening(10**6, [10**12 + 7, 10**12 - 3], np.eye(2), np.ones(2), 2.0)
    x = np.array([[10**6 + 5, 10**6], [2**52, -2**52]])
    assert model.deviation(x) == [(10**6 * (10**6 + 5) - 10**12 - 7) ** 2 + 9, None]
