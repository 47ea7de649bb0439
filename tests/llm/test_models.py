import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskengine.llm import langid, lbl
from riskengine.llm.common import slices
from riskengine.llm.queries import REGISTRY

from . import util


def held(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 1


def test_language_query(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in util.documents(sf_dir)}
    got = REGISTRY["op2_langid"](spark, sf_dir).collect()
    assert {r.doc_id: r.held_out for r in got} == {d: held(d, 3) for d in lang}
    unseen = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in got)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    model = langid.Crf(["a", "b", "c"])
    model.moves, model.first = rng.normal(size=(3, 3)), rng.normal(size=3)
    emissions = rng.normal(size=(9, 3))
    words = np.array([[0, 1, 2, 3], [4, 5, -1, -1], [6, -1, -1, -1]])
    lengths = np.array([4, 2, 1])
    p, expected = model.marginals(emissions, words, lengths)
    total = np.zeros((3, 3))
    for chain, n in zip(words, lengths):
        z, want, pairs = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*(3,) * n):
            s = model.first[path[0]] + sum(emissions[chain[t], y] for t, y in enumerate(path)) + sum(model.moves[a, b] for a, b in zip(path, path[1:]))
            w = math.exp(s)
            z += w
            for t, y in enumerate(path):
                want[t, y] += w
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w
        total += pairs / z
        assert np.allclose(p[list(map(tuple, words)).index(tuple(chain))][:n], want / z)
    assert np.allclose(expected, total)


def test_words_of_two_languages_get_their_own_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    texts = {r["lang"]: r["text"] for r in util.documents(sf_dir) if len(r["text"]) > 2000 and "%%" not in r["text"]}
    mixed = texts["en"][:1500] + " " + texts["de"][:1500]
    for _, _, data, offsets in slices(pa.array([mixed])):
        p, _, _, _ = langid.label_words(model, data, offsets)
    best = p.argmax(1)
    half = len(best) // 2
    en, de = model.languages.index("en"), model.languages.index("de")
    assert (best[: half - 20] == en).mean() > 0.9 and (best[half + 20 :] == de).mean() > 0.9


def test_language_of_odd_rows(spark):
    rows = util.ODD + [(1, "der und die", "de", "x", 0), (3, "the and of", "en", "x", 0), (5, "12 — 34", "en", "x", 0), (6, "—", "de", "x", 0), (7, "日本", None, "x", 0)]
    df = spark.createDataFrame(rows, util.SCHEMA).withColumnRenamed("source", "score")
    got = langid.identify(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for d in (1000, 1001, 1002, 5, 6):
        assert (by[d].lang_pred, by[d].score) == ("und", 0.0)
    assert by[7].lang_pred in ("de", "en") and by[None].held_out is False
    assert langid.identify(util.empty(spark)).count() == 0
    unlabelled = langid.identify(util.odd(spark).filter("lang IS NULL")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def base(rows):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter(w for d, t in rows if not held(d, 5) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for d, t in rows:
        w = tokens(t)
        score = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((d, held(d, 5), len(w), sum(count[x] > 0 for x in w), n, round(score, 6)))
    return sorted(out, key=str)


def rounded(got):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)


@pytest.mark.parametrize("head", [lbl.HEAD, 30])
def test_scores(spark, sf_dir, monkeypatch, head):
    monkeypatch.setattr(lbl, "HEAD", head)
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    got = REGISTRY["op10_lbl"](spark, sf_dir).collect()
    assert rounded(got) == base(rows)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_class_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    model = lbl.LogBilinear(np.full(lbl.CLASSES, 1 / lbl.CLASSES))
    before = rng.integers(0, lbl.CLASSES, (5, lbl.CONTEXT))
    every = np.stack([model.log_probabilities(before, np.full(5, c)) for c in range(lbl.CLASSES)])
    assert np.allclose((10.0**every).sum(0), 1, atol=1e-5)


def test_training_learns_what_follows():
    rng = np.random.default_rng(3)
    token = rng.integers(1, 9, 60_000)
    token[1::2] = token[::2] + 10
    docs = np.arange(len(token)) // 100
    shares = (np.bincount(token, minlength=lbl.CLASSES) + 0.5) / (len(token) + lbl.CLASSES / 2)
    model = lbl.LogBilinear(shares)
    before = lbl.contexts(token, docs)
    sums = [np.zeros(p.shape) for p in (model.context, model.target, model.bias)]
    for _ in range(20):
        model.train(before, token, shares, sums, rng)
    assert model.log_probabilities(before, token)[1::2].mean() > np.log10(shares[token])[1::2].mean() + 0.3


def test_scores_of_odd_rows(spark):
    got = lbl.score_documents(util.odd(spark).withColumnRenamed("source", "score")).collect()
    assert rounded(got) == base([(r[0], r[1]) for r in util.ODD])
    assert lbl.score_documents(util.empty(spark)).count() == 0
