"""Spectral divide and conquer and whitening against numpy's eigenvectors and exact sums."""

import numpy as np
import pytest

from patronage.llm import whitening
from patronage.llm.queries import QUERIES


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 65.0),
        np.geomspace(1, 1e-12, 40),
        np.ones(12),
        np.array([5.0, 5, 5, 1, 1, 0, 0, 0]),
        np.array([1e6, 1.0]),
        np.array([3.0]),
        np.r_[np.ones(30), 1 + 1e-9, 2.0],
        np.array([2.0, 1, 0, -1, -2]),
        np.zeros(4),
    ],
)
def test_components_are_those_of_numpy(values):
    rng = np.random.default_rng(2)
    a = symmetric(rng, values)
    got, vectors = whitening.leading_components(a, 4)
    want = np.sort(values)[::-1][:4]
    norm = max(np.abs(values).max(), 1e-300)
    assert np.abs(got - want).max() <= 1e-13 * norm * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-13 * norm * len(values)


def test_components_of_a_diagonal_with_the_shift_among_its_values():
    for a in (np.diag([3.0, 2, 1]), np.array([[1.0, 2, 0], [2, 1, 0], [0, 0, 1]]), np.kron(np.eye(5), [[0, 1.0], [1, 0]])):
        got, vectors = whitening.leading_components(a, 3)
        assert np.abs(got - np.sort(np.linalg.eigvalsh(a))[::-1][:3]).max() < 1e-14 * 9
        assert np.abs(a @ vectors - vectors * got).max() < 1e-13


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(4)
    for smallest in (1e-1, 1e-8, 1e-14):
        values = np.r_[np.geomspace(smallest, 1, 10), -np.geomspace(smallest, 3, 11)]
        a = symmetric(rng, values)
        u = whitening.polar_factor(a)
        assert np.abs(u @ u - np.eye(21)).max() < 1e-12
        assert np.linalg.norm(u @ a - a @ u) < 1e-12 and np.linalg.eigvalsh(u @ a).min() > -1e-12


def brute_force(rows, k=4):
    x = {r[0]: np.floor(256 * np.array(r[1], float)).astype(int) for r in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), [sum(map(int, c)) for c in fit.T]
    centred = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for key, v in x.items():
        deviation = sum((n * int(a) - s) ** 2 for a, s in zip(v, sums, strict=True))
        for c in range(k):
            out[key, c + 1] = (n, deviation, (v - np.array(sums) / n) @ vectors[:, c] / np.sqrt(values[c]), values[c] / values.sum())
    return out


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(8)
    mix = rng.standard_normal((16, 16)) * np.linspace(0.2, 1.5, 16)
    rows = [(k, [float(np.float32(v)) for v in rng.standard_normal(16) @ mix]) for k in range(500)]
    rows += [(500 + k, rows[3][1]) for k in range(250)]
    odd = [(900, None), (901, [None, *rows[0][1][1:]]), (902, [float("nan"), *rows[0][1][1:]]), (903, [float("-inf"), *rows[0][1][1:]])]
    frame = spark.createDataFrame([(*r, "clash", 1.5) for r in rows + odd], "vec_id bigint, embedding array<float>, N string, whitened double")
    model = whitening.fit_whitening(frame)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whitened_components(frame, model).collect()}
    want = brute_force(rows)
    assert got.keys() == want.keys()
    sign = {c: np.sign(got[0, c]["whitened"] * want[0, c][2]) for c in range(1, 5)}
    for key, (n, deviation, white, explained) in want.items():
        r = got[key]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(sign[key[1]] * r["whitened"] - white) < 1e-10 and abs(r["explained"] / explained - 1) < 1e-10
        assert r["identity_error"] < 1e-10
    # A null id and a repeated row are rows like any other.
    again = spark.createDataFrame([(None, rows[3][1]), (None, rows[3][1])], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(again, model).count() == 2


def test_vectors_without_components(spark):
    schema = "vec_id bigint, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])]):
        frame = spark.createDataFrame(rows, schema)
        out = whitening.whitened_components(frame, whitening.fit_whitening(frame))
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]
    # Two entries that move together: one component; a shorter vector ends in zeros.
    frame = spark.createDataFrame([(1, [1.0, 1.0]), (2, [3.0, 3.0]), (3, [])], schema)
    out = whitening.whitened_components(frame, whitening.fit_whitening(frame)).collect()
    assert sorted(r["vec_id"] for r in out) == [1, 2, 3] and {r["component"] for r in out} == {1}
    assert all(r["deviation"] == {1: 2 * 256**2, 2: 2 * 5**2 * 256**2, 3: 2 * 4**2 * 256**2}[r["vec_id"]] for r in out)


def test_deviations_beyond_the_range(spark):
    frame = spark.createDataFrame([(1, [1e30]), (2, [-1e30]), (3, [1e6])], "vec_id bigint, embedding array<double>")
    model = whitening.fit_whitening(frame)
    assert model.sums == [2**63 - 1 - 2**63 + 256 * 10**6]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame, model).collect()}
    assert got == {1: None, 2: None, 3: (3 * 256 * 10**6 - model.sums[0]) ** 2}


def test_query_keeps_every_usable_row(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op12_embedding_whitening"](spark, sf)
    assert out.count() == 4 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert out.agg({"identity_error": "max"}).first()[0] < 1e-9
