import numpy as np
import pytest

from riskengine.llm import vptree
from riskengine.llm.queries import ORACLES, REGISTRY

from . import util


def brute(ids, v, asked, q, k):
    out = []
    for i, x in zip(asked, q):
        s = [(-float(vptree.cosine(x[None], y[None])[0]), j) for j, y in zip(ids, v) if j != i]
        out += [(i, r + 1, j, -a) for r, (a, j) in enumerate(sorted(s)[:k])]
    return out


def test_tree_is_exact_at_factor_one():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(3000, 6))
    v[1000:1400] = v[0]  # many copies
    ids = np.arange(3000)
    unit = vptree._unit(v)
    rows, away = vptree.Tree(unit, ids, leaf=16).search(unit[::50], ids[::50], 7)
    for q, got in zip(ids[::50], rows):
        d = np.sqrt(np.maximum(0, 2 - 2 * unit @ unit[q])).round(12)
        d[q] = np.inf
        assert got.tolist() == np.lexsort((ids, d))[:7].tolist()


@pytest.mark.parametrize("leaf", [16, 128])
def test_copies_of_a_query_go_by_the_smaller_id(leaf):
    """Far more copies than are asked for, over many leaves, for queries in blocks of many shapes."""
    rng = np.random.default_rng(8)
    for d in (3, 64):
        v = rng.normal(size=(1500, d)) * rng.uniform(0.1, 9, (1500, 1))
        copies = rng.permutation(1500)[:900]
        v[copies] = v[copies[np.arange(900) % 3]]
        ids = rng.permutation(5000)[:1500]
        order = np.argsort(ids)
        v, ids = v[order], ids[order]
        asked = rng.permutation(1500)[:211]
        tree = vptree.Tree(vptree._unit(v), ids, leaf, vectors=v)
        rows, scores = tree.search(vptree._unit(v[asked]), ids[asked], 5, asked=v[asked])
        for q, got, exact in zip(asked, rows, scores):
            score = vptree.cosine(np.broadcast_to(v[q], v.shape), v)
            score[q] = -np.inf
            want = np.lexsort((ids, -score))[:5]
            assert got.tolist() == want.tolist()
            assert exact.tolist() == score[want].tolist()


def test_many_copies_in_one_shard(spark):
    rng = np.random.default_rng(9)
    few = rng.normal(size=(4, 48)).tolist()
    rows = [(i, few[i % 4]) for i in rng.permutation(4000).tolist()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vptree.nearest(df, df.filter("vec_id % 37 = 0"), 5).collect()
    by = {}
    for r in sorted(got):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {q: [i for i in range(q % 4, 40, 4) if i != q][:5] for q in range(0, 4000, 37)}


def test_a_factor_skips_more_but_finds_most():
    rng = np.random.default_rng(5)
    unit = vptree._unit(rng.normal(size=(20_000, 4)))
    ids = np.arange(len(unit))
    tree = vptree.Tree(unit, ids, leaf=32)
    exact, _ = tree.search(unit[::100], ids[::100], 5)
    near, _ = tree.search(unit[::100], ids[::100], 5, factor=1.3)
    recall = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(exact.tolist(), near.tolist())])
    assert 0.9 <= recall <= 1


def test_odd_vectors_ties_and_shards(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(400)]
    rows += [(400, None), (450, [0.0] * 4), (500, [float("nan"), 1.0, 1.0, 1.0]), (550, [1.0, None, 1.0, 1.0]), (600, []), (650, [float("inf"), 0.0, 0.0, 1.0])]
    rows += [(700, [1e300, 0.0, 0.0, 1e300]), (701, [1e-300, 0.0, 0.0, 1e-300]), (None, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, v = [g[0] for g in good], [g[1] for g in good]
    asked = [(i, x) for i, x in good if i % 50 == 0]
    want = brute(ids, v, [a[0] for a in asked], [a[1] for a in asked], 5)
    got = vptree.nearest(df, df.filter("vec_id % 50 = 0"), 5, rows_per_shard=60, queries_per_block=3)
    got = sorted(tuple(r) for r in got.collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-15)
    assert vptree.nearest(df.limit(0), df.limit(0), 5).count() == 0


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = vptree.nearest(df, df.filter("vec_id = 50"), 5).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(50, 1, 2), (50, 2, 1)]


def test_query(spark, sf_dir):
    got = sorted(tuple(r) for r in REGISTRY["op9_vptree"](spark, sf_dir).collect())
    want = sorted(util.sql(sf_dir, ORACLES["op9_vptree"], ["embeddings"]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-9)
