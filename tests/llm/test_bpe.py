import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from riskengine.llm import bpe
from riskengine.llm.common import slices
from riskengine.llm.queries import REGISTRY

from . import util

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(own, texts):
    out = []
    for _, _, data, offsets in slices(pa.array(texts), 2_000):
        ids, counts = own.encode(data, offsets)
        out += np.split(ids, np.cumsum(counts)[:-1])
    return out


def test_equals_the_library_on_odd_texts(library):
    rnd = random.Random(1)
    parts = ["a", "the", "é", " ", "  ", "\n", "\t", "'s", "'ll", "1", "22", "!", " ", "ß", " ", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "—", "日本", "́"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["", " ", "   ", "\r\n\r\n x", "a\n  b", "x" * 5000, "ab" * 3000 + "  " + "é" * 1000, "\x1c\x1d a", "½² ١٢٣"]
    got = encode(bpe.Encoder(PATH, P.PATTERN, remembered=500), texts)
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]


def test_a_very_long_piece(library):
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(200_000))
    got = encode(bpe.Encoder(PATH, P.PATTERN), [text])[0]
    assert bpe.token_table(PATH).gather(got)[0].tobytes() == text.encode()
    assert got[:500].tolist() == library.encode_ordinary(text)[:500]


def test_rank_queue_gives_the_least_rank():
    queue, want = bpe.RankQueue(50_000), {}
    rnd = random.Random(3)
    for i in range(5000):
        r = rnd.randrange(50_000)
        queue.push(r, i)
        want.setdefault(r, []).append(i)
    for r in sorted(want):
        assert queue.first() == r and queue.take(r) == want[r]
    assert queue.first() == -1


def test_rows_and_columns(spark, library):
    docs = util.odd(spark).withColumnRenamed("source", "ids")
    out = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH)
    assert out.columns == ["doc_id", "lang", "n_chars", "ids", "decoded"]
    got = sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in out.collect())
    want = sorted((str(r[0]), tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in util.ODD)
    assert got == want
    assert bpe.digests(bpe.decode(bpe.encode(util.empty(spark), PATH, P.PATTERN), PATH)).count() == 0


def test_query(spark, sf_dir, library):
    want = {}
    for r in util.documents(sf_dir):
        ids = library.encode_ordinary(r["text"] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in REGISTRY["op4_bpe"](spark, sf_dir).collect()}
    assert got == want
