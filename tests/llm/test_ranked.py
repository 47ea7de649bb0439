import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskengine.llm import ranked
from riskengine.llm.queries import ORACLES, REGISTRY

from . import util

TERM = re.compile(ranked.TERM)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    by_item = {}
    for i, text in items:
        by_item.setdefault(i, set()).update(terms(text))
    out = []
    for i, wanted in by_item.items():
        scored = []
        for d, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("run", [2, 5, 16])
def test_shared_sums_are_the_plain_sums(run):
    rnd = random.Random(run)
    common = [rnd.sample(range(60), 8) for _ in range(6)]
    items = [sorted({*rnd.choice(common), *rnd.choice(common), *rnd.sample(range(100), rnd.randint(0, 9))}) for _ in range(40)]
    graph = ranked.Shared(items, 100, run)
    leaves = np.array([[rnd.randrange(1 << 40) for _ in range(7)] for _ in range(100)])
    impacts = np.zeros((graph.nodes, 7), np.int64)
    impacts[:100] = leaves
    assert (graph.scores(impacts) == np.array([leaves[own].sum(0) for own in items])).all()
    assert graph.additions() < sum(len(own) - 1 for own in items) * 0.8


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked, "CANDIDATES", 40)
    monkeypatch.setattr(ranked, "ACCUMULATORS", 20_000)
    rnd = random.Random(7)
    words = ["alpha", "Beta", "γάμμα", "42", "d-e", "it's", "ΑΒΓ", "x", "日本", "beta"]
    docs = [(r[0], r[1]) for r in util.ODD]
    docs += [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))) for i in range(200)]
    docs += [(i, "alpha beta same text") for i in range(500, 560)]
    items = [(1, "ALPHA beta"), (2, "the rows without an id x 42 日本"), (3, None), (4, "..."), (None, "alpha γάμμα"), (5, "same text"), (5, "twice it")]
    items += [(10 + i, " ".join(rnd.sample(words, 4))) for i in range(20)]
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id AS rank", "doc_id AS score", "'x' AS item_id")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id", "1 AS terms")
    got = ranked.search(left, right, k=5, block_bytes=60)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, 5)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(util.empty(spark), items).count() == 0
    assert ranked.search(util.odd(spark), items.limit(0)).count() == 0
    assert ranked.search(util.odd(spark), items.selectExpr("item_id", "'?!' AS text")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    want = util.sql(sf_dir, ORACLES["op13_ranked"], ["documents", "benchmark"])
    assert sorted(tuple(r) for r in REGISTRY["op13_ranked"](spark, sf_dir).collect()) == sorted(want)
