import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskengine.llm import trie
from riskengine.llm.common import slices
from riskengine.llm.queries import REGISTRY

from . import util

PATH = P.path("byte_bpe_50k.json")
PARTS = ["a", "the", "é", " ", "  ", "\n", "\t", "'s", "1", "22", "!", "ß", "\x1f", "\x85", "\xa0", "　", "日本", "́", "aaaa",
         "<|endoftext|>", "<|endof", "text|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(own, texts, limit=2_000):
    out = []
    for _, _, data, offsets in slices(pa.array(texts), limit):
        ids, counts = own.encode(data, offsets)
        out += np.split(ids, np.cumsum(counts)[:-1])
    return [o.tolist() for o in out]


def test_equals_the_library(library):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(chr(rnd.randrange(33, 0x2FFF)) for _ in range(40)) for _ in range(300)]
    texts += ["", " ", "a" * 7, "a" * 5001, "ab" * 3000 + "  " + "é" * 1000, "<|endoftext|>", "x <|endoftext|> <|endoftext|>\n"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encode(trie.Encoder(PATH, remembered=500), texts) == want


def test_every_token_and_very_long_words(library):
    own = trie.Trie(trie.Vocabulary(PATH))
    tokens = {t: i for t, i in own.vocabulary.ids.items()}
    assert own.encode(tokens) == {t: [i] for t, i in tokens.items()}
    word = "".join(random.Random(2).choice("abcdefgh") for _ in range(100_000))
    assert own.encode([word.encode(), word[:60_000].encode()])[word.encode()] == library.encode(word, add_special_tokens=False).ids


def test_shared_prefixes_are_worked_out_once(monkeypatch):
    own, steps = trie.Trie(trie.Vocabulary(PATH)), []

    class Counted(dict):
        def get(self, key, default=None):
            steps.append(key)
            return super().get(key, default)

    monkeypatch.setattr(own, "_steps", Counted())
    words = [b"international" + bytes([c]) * 3 for c in range(97, 123)]
    own.encode(words)
    assert len(steps) == 13 + 3 * 26


def test_rows_and_columns(spark, library):
    docs = util.odd(spark).withColumnRenamed("source", "ids").withColumnRenamed("lang", "n_tokens")
    out = trie.decode(trie.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "n_tokens", "n_chars", "ids", "decoded"]
    got = sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in out.collect())
    want = sorted((str(r[0]), tuple(library.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in util.ODD)
    assert got == want
    assert trie.digests(trie.encode(docs, PATH), PATH).columns == ["doc_id", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert trie.digests(trie.encode(util.empty(spark), PATH), PATH).count() == 0
    broken = spark.createDataFrame([([50256, 162],)], "ids array<int>")
    assert trie.decode(broken, PATH).first().decoded == library.decode([50256, 162], skip_special_tokens=False)


def test_query(spark, sf_dir, library):
    want = {}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in util.documents(sf_dir):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in REGISTRY["op11_trie"](spark, sf_dir).collect()}
    assert got == want
