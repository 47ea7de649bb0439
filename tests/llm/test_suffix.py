import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from riskengine.llm import suffix
from riskengine.llm.queries import REGISTRY

from . import util


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        starts = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length, gram):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, removed string, at int")
    got = suffix.digests(suffix.remove_repeats(df, length=length, gram=gram)).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)
    want = sorted(((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], length))), key=str)
    assert got == want


@pytest.mark.parametrize(("length", "gram", "hot", "group"), [(20, 6, 10**6, 10**6), (20, 6, 10**6, 40), (20, 6, 5, 200), (40, 3, 10**6, 300)])
def test_equals_brute_force(spark, monkeypatch, length, gram, hot, group):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "ROWS_PER_GROUP", group)
    rnd = random.Random(length + gram)
    some = lambda n, letters="abé": "".join(rnd.choice(letters) for _ in range(n))
    passage, line = some(60, "abcdefgh"), some(length - 3, "abcdefgh") + "äö"
    texts = [some(rnd.randint(0, 90), "abcdefgh") + rnd.choice([passage, passage[5:45], line, "", passage + passage]) + some(rnd.randint(0, 60), "abcdefgh") for _ in range(40)]
    texts += ["a" * 100, "a" * 21, "a" * 20, "a" * 19, "ab" * 40, some(400, "ab"), some(300, "ab"), "x" + passage, passage[: length], None, ""]
    texts += [texts[0], texts[1], texts[1], "aaab" * 30]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5]), (None, texts[5])]
    check(spark, rows, length, gram)


def test_deep_shallow_sort():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 2, (500, 90)).astype(np.uint8)
    rows[100:300] = rows[:200]  # copies
    rows[300:350, :80] = rows[0, :80]
    order = suffix.deep_shallow_sort(rows, shallow=16)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)
    agree = suffix.agreements(rows, order)
    for k in range(1, 500):
        a, b = rows[order[k]], rows[order[k - 1]]
        assert agree[k] == (90 if (a == b).all() else (a != b).argmax())


def test_windows():
    v = np.random.default_rng(1).integers(0, 50, 100).astype(np.uint64)
    for width in (1, 3, 100, 101):
        assert suffix.least_in_windows(v, width).tolist() == [v[i : i + width].min() for i in range(100 - width + 1)]


def test_odd_rows(spark):
    got = suffix.digests(suffix.remove_repeats(util.odd(spark))).collect()
    want = brute([r[1] for r in util.ODD[:-1]], 200)  # the last one is too long for brute force
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id != 1006), key=str)
    assert got == sorted(((r[0], *b) for r, b in zip(util.ODD[:-1], want)), key=str)
    assert suffix.remove_repeats(util.empty(spark)).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in REGISTRY["op3_suffix"](spark, sf_dir).collect())
    assert got == sorted((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], 200)))
