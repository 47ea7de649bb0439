import numpy as np
import pyarrow.parquet as pq
import pytest

from riskengine.llm import whiten
from riskengine.llm.queries import REGISTRY

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(ids, vectors, k=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    held = values > 1e-9 * values[0]
    values, axes, whole = values[held][:k], axes[:, held][:, :k], values.sum()
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    return n, deviation, ((x - s / n) @ axes) / np.sqrt(values), values / whole


def compare(got, ids, vectors, k=16, tolerance=1e-8):
    n, deviation, white, explained = brute(ids, vectors, k)
    count = white.shape[1]
    rows = sorted((r.vec_id, i, r) for i, r in enumerate(got))
    by_id = {}
    for i, _, r in rows:
        by_id.setdefault(i, []).append(r)
    assert len(got) == len(ids) * count and {r.n for r in got} == {n}
    assert all(r.identity_error <= 1e-9 for r in got)
    one = [sorted(by_id[i], key=lambda r: r.component)[:: max(1, len(by_id[i]) // count)] for i in ids]
    mine = np.array([[r.whitened for r in own] for own in one])
    assert [own[0].deviation for own in one] == deviation
    signs = np.sign((mine * white).sum(0))
    assert np.abs(mine * signs - white).max() < tolerance
    assert np.allclose([r.explained for r in one[0]], explained, rtol=1e-9)


def test_query(spark, sf_dir):
    rows = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()
    rows = [r for r in rows if r["embedding"] is not None and all(v is not None and np.isfinite(v) for v in r["embedding"])]
    got = REGISTRY["op12_whiten"](spark, sf_dir)
    assert got.columns == NAMES
    compare(got.collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_close_and_distant_values(spark):
    """Filtered, with values from 1e6 down to 1 and several nearly equal."""
    rng = np.random.default_rng(3)
    spread = np.concatenate([[1000, 300, 299.9], np.linspace(40, 30, 20), np.ones(40)])
    axes = np.linalg.qr(rng.standard_normal((63, 63)))[0]
    vectors = (rng.standard_normal((400, 63)) * spread) @ axes
    own = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    compare(whiten.whiten(own, k=8).collect(), list(range(400)), vectors, 8, 1e-7)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [rng.standard_normal(5).tolist() for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(100, good[0])] * 30 + [(101, good[1])]
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0] * 4, [1e300] * 5]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + list(enumerate(odd, 200))], "vec_id long, embedding array<double>, n string, x int")
    got = whiten.whiten(table).collect()
    assert len(got) == 91 * 5 and {r.vec_id for r in got} == {*range(60), 100, 101}
    unique = {}
    for r in got:
        unique[r.vec_id, r.component] = r
    compare(list(unique.values()), [*range(60), 100, 101], [*good, good[0], good[1]])
    unnamed = whiten.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in unnamed] == [(None, 1, 1.0, pytest.approx(1))] * 2


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whiten.whiten(spark.createDataFrame(rows, schema))
        assert got.columns == NAMES and got.count() == 0


def test_great_numbers(spark):
    vectors = [[2.0**40 * (i + 1), float(i % 3)] for i in range(6)] + [[2.0**50, 1.0]]
    got = whiten.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    exact = brute(range(7), vectors)[1]
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2**63 else None for i, d in enumerate(exact)}
    assert None in {r.deviation for r in got}
