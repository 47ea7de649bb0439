import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from riskengine.llm import simhash
from riskengine.llm.queries import REGISTRY

from . import util


def bits(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def check(got, rows):
    """Every derived column from the fingerprints and the texts."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by = {r.doc_id: r for r in got}
    near = {}
    prints = sorted({r.fingerprint for r in got})
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if bits(a, b) <= 3:
                near[a], near[b] = near.get(a, 0) + 1, near.get(b, 0) + 1
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)]
        t, k = t or "", len(t or "") // 4
        edited = t[: len(t) - k] + (after[1] or "")[:k]
        r = by[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == 1 - bits(r.fingerprint, r.edited_fingerprint) / 128
        assert r.near_next == 1 - bits(r.fingerprint, by[after[0]].fingerprint) / 128
        assert r.n_near == near.get(r.fingerprint, 0)
    texts = {}
    for d, t in rows:
        texts.setdefault(t or "", set()).add(by[d].fingerprint)
    assert all(len(p) == 1 for p in texts.values())


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    got = REGISTRY["op6_simhash"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    check(got, rows)
    assert sum(r.near_edited > r.near_next for r in got) > 0.97 * len(got)


def test_odd_rows(spark):
    got = simhash.edited_fingerprints(util.odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in util.ODD)
    check(got, list(dict.fromkeys((r[0], r[1]) for r in util.ODD)))
    assert {r.fingerprint for r in got if r.doc_id in (1000, 1001)} == {"0" * 32}
    assert simhash.edited_fingerprints(util.empty(spark)).count() == 0
    one = simhash.edited_fingerprints(util.odd(spark).filter("doc_id = 1004")).collect()
    assert one[0].near_next == 1.0


def test_a_single_term_votes_its_own_bits(spark):
    r = simhash.fingerprints(spark.createDataFrame([(1, "word")], "k long, t string"), ["k"], "t").first()
    term = spark.sql("SELECT (xxhash64('word', cast(null as string)) & -16L) | 4L AS t")
    want = term.select(F.xxhash64("t", F.lit(0)), F.xxhash64("t", F.lit(1))).first()
    assert (r.f0, r.f1) == tuple(want)


def plain(text):
    """The fingerprint of a text in plain Python."""
    words = re.split(r"[ \t\n\x0b\f\r]+", text.lower())
    votes, every = [0] * 128, 0
    for i, w in enumerate(words):
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        if i + 1 < len(words):
            h = xxhash.xxh64_intdigest(words[i + 1].encode(), h)
        weight = min(len(w), 15)
        term = (h & ~15 | weight).to_bytes(8, "little")
        every += weight
        for k in (0, 1):
            bits_ = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(term, 42))
            for j in range(64):
                votes[64 * k + j] += weight * (bits_ >> j & 1)
    value = [sum((2 * v > every) << j for j, v in enumerate(votes[64 * k : 64 * k + 64])) for k in (0, 1)]
    return "%016x%016x" % tuple(value)


def test_fingerprints_of_whole_texts_equal_plain_python(spark, sf_dir):
    rows = sorted(util.documents(sf_dir), key=lambda r: len(r["text"]))
    rows = rows[:20] + rows[len(rows) // 2 :][:20]
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.edited_fingerprints(df).collect()}
    by_id = sorted(rows, key=lambda r: r["doc_id"])
    for r, after in zip(by_id, by_id[1:] + by_id[:1]):
        t, k = r["text"], len(r["text"]) // 4
        assert got[r["doc_id"]].fingerprint == plain(t)
        assert got[r["doc_id"]].edited_fingerprint == plain(t[: len(t) - k] + after["text"][:k])


def test_many_equal_rows_count_once(spark):
    text = "votes of equal rows must not add up " * 300
    one = spark.createDataFrame([(1, text), (2, "another text")], "doc_id long, text string")
    many = one.filter("doc_id = 1").crossJoin(spark.range(3000).select()).unionByName(one.filter("doc_id = 2"))
    want = {tuple(r) for r in simhash.edited_fingerprints(one).collect()}
    got = simhash.edited_fingerprints(many.withColumn("fingerprint", F.lit("extra")).withColumn("copies", F.lit(0)))
    assert got.count() == 3001 and {tuple(r) for r in got.distinct().collect()} == want


def test_block_tables_find_all_pairs(spark):
    rnd = random.Random(3)
    prints = [rnd.getrandbits(128) for _ in range(150)]
    for p in prints[:100]:
        q = p
        for b in rnd.sample(range(128), rnd.randint(1, 6)):
            q ^= 1 << b
        prints.append(q)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p & (1 << 64) - 1), signed(p >> 64)) for p in prints] * 2
    df = spark.createDataFrame(rows, "f0 long, f1 long")
    distinct = sorted(set(rows))
    apart = lambda a, b: sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a, b))
    for radius, blocks in ((0, 1), (1, 2), (3, 4), (4, 8)):
        want = {(*a, *b, apart(a, b)) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if apart(a, b) <= radius}
        assert {tuple(r) for r in simhash.within(df, radius, blocks).collect()} == want
