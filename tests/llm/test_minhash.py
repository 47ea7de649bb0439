import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riskengine.llm import minhash
from riskengine.llm.components import components, forest
from riskengine.llm.queries import REGISTRY

from . import util


def shingles(text, words):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def brute(rows, words, percent):
    """All pairs that share a shingle, verified."""
    sets, holders, edges = [shingles(t, words) for _, t in rows], {}, []
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for own in holders.values() for i in own for j in own if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            edges.append((rows[i][0], rows[j][0]))
    least = forest([e for e in edges if None not in e])
    return sorted((d, len(s), least.get(d, d), least.get(d, d) == d) for (d, _), s in zip(rows, sets))


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    got = sorted(tuple(r) for r in REGISTRY["op1_minhash"](spark, sf_dir).collect())
    assert got == brute(rows, 3, 85)


def edited(rnd, words, share):
    return " ".join(rnd.choice(["alpha", "beta", "gamma"]) + str(rnd.random()) if rnd.random() < share else w for w in words)


@pytest.mark.parametrize("block", [2048, 7])
def test_groups_that_no_single_member_links(spark, monkeypatch, block):
    """Copies of copies: a chain of links, a group around the threshold, one common passage, exact copies."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rnd, texts = random.Random(7), []
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    texts += [edited(rnd, base, 0.02) for _ in range(60)]
    chain = [word() for _ in range(200)]
    for k in range(20):
        chain = [*chain[:k * 8], *(word() for _ in range(4)), *chain[k * 8 + 4 :]]
        texts.append(" ".join(chain))
    passage = [word() for _ in range(40)]
    texts += [" ".join([word() for _ in range(60)] + passage + [word() for _ in range(30)]) for _ in range(40)]
    texts += [" ".join(base)] * 5 + ["One two", "one TWO", "one", "two one", "a b c", "A  b\tc"] + [None, "", " \n"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts, 100))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, rep string, key int")
    got = sorted(tuple(r) for r in minhash.near_duplicates(df, 3, 85).collect())
    assert got == brute(rows, 3, 85)


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_families_whose_least_member_is_just_below_the_threshold(spark, words, percent):
    """Near copies of each other that miss the first member: most retained values are common to the whole family."""
    rnd, rows = random.Random(11), []
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    for family in range(160):
        base = [word() for _ in range(rnd.randint(100, 300))]
        n = len(base) - words + 1
        # A run of new words costs the run and words - 1 shingles; the first member lies 1 to 3 % below the threshold.
        gone = round(n * (1 - (percent - rnd.uniform(1, 3)) / 100) / (1 + (percent - 2) / 100)) - words + 1
        at = rnd.randrange(words, len(base) - gone - words)
        texts = [base[:at] + [word() for _ in range(gone)] + base[at + gone :]]
        for _ in range(rnd.randint(2, 9)):
            where = rnd.randrange(len(base))
            texts.append(base[:where] + [word()] + base[where + 1 :])
        rows += [(100 * family + k, " ".join(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(df, words, percent).collect())
    assert got == brute(rows, words, percent)


def test_open_members_are_all_that_have_a_possible_partner():
    rng = np.random.default_rng(3)
    for round in range(120):
        n, held = int(rng.integers(2, 9)), int(rng.integers(1, 14))
        common = rng.choice(2**62, held, replace=False)
        pool = rng.choice(2**62, 30, replace=False)
        sets = [np.unique(np.concatenate([common, rng.choice(pool, int(rng.integers(0, 16)), replace=False)])).astype(np.uint64) for _ in range(n)]
        comp = rng.integers(0, 3, n)
        table = pa.table({
            "key": [1] * n, "i": [0] * n, "j": [0] * n, "rep": list(range(n)), "component": comp,
            "n_shingles": [len(s) for s in sets], "values": pa.array([s[:16].tobytes() for s in sets], pa.binary()),
        })
        for similarity in (0.85, 0.8):
            sketch, size = minhash._rows(table.column("values").to_pylist()), np.array([len(s) for s in sets])
            want = {i for i in range(n) if len(minhash._possible(sketch, size, i, np.flatnonzero(comp != comp[i]), similarity))}
            got = set(minhash._open_members(similarity)(table).column("rep").to_pylist())
            assert want <= got
            if min(size) >= 16:
                assert want == got


def test_odd_rows(spark):
    got = sorted(minhash.near_duplicates(util.odd(spark), 5, 80).collect(), key=str)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[None] == [(2, None, True)] * 2
    assert by[1000] == [(0, 1000, True)] and by[1002] == [(0, 1002, True)]
    assert by[1003] == [(4, 1003, True)] * 2
    assert minhash.near_duplicates(util.empty(spark)).count() == 0


def test_estimate_is_exact_for_small_sets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.sort(rng.choice(20, rng.integers(1, 9), replace=False)).astype(np.uint64) for _ in "ab")
        rows = [minhash._rows([x.tobytes()]) for x in (a, b)]
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert minhash.estimate(*rows)[0] == pytest.approx(want)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(3000), rnd.randrange(3000)) for _ in range(1400)] + [(i, i + 1) for i in range(5000, 5200)] + [(9000, i) for i in range(9001, 9500)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(16)
    got = {r.vertex: r.component for r in components(df).collect()}
    want = forest([e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(df.limit(0)).count() == 0
