import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskengine.llm import packing, tokenfile, tokens
from riskengine.llm.common import slices
from riskengine.llm.queries import REGISTRY

from . import util

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, want, size):
    """Every token once, in pieces that are whole but for long documents; sequences without gaps or overlaps."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    got = Counter()
    for doc_id, pieces in docs.items():
        for r in pieces:
            got[(doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    assert got == want
    return len(sequences)


def pieces(doc_id, ids, size):
    ids = np.array(ids, "<u4")
    return [(doc_id, k, a, len(ids[a : a + size]), zlib.crc32(ids[a : a + size].tobytes())) for k, a in enumerate(range(0, len(ids), size))]


def wanted(rows, tokenizer, end, size):
    return Counter(p for d, t in rows for p in pieces(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [end], size))


def test_query(spark, sf_dir, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    want = wanted(rows, tokenizer, 0, 2048)
    used = check(REGISTRY["op5_packing"](spark, sf_dir).collect(), want, 2048)
    least = -(-sum(p[3] for p in want.elements()) // 2048)
    assert used <= least + 1


def test_odd_rows_and_blocks(spark, tokenizer):
    want = wanted([(r[0], r[1]) for r in util.ODD], tokenizer, 0, 64)
    table = packing.token_pieces(util.odd(spark), PATH, 0, 64).cache()
    assert {zlib.crc32(r.ids) == r.ids_crc32 for r in table.collect()} == {True}
    check(packing.pack(table, 64, rows_per_block=100).collect(), want, 64)
    assert packing.pack_documents(util.empty(spark), PATH).count() == 0


def test_plan_uses_every_piece_once_and_few_sequences():
    rng = np.random.default_rng(1)
    lengths = np.minimum(2048, rng.lognormal(6, 1, 200_000).astype(int) + 1)
    histogram = dict(Counter(lengths.tolist()))
    got = packing.plan(histogram, 2048)
    used = Counter()
    for own, times in got:
        assert sum(own) <= 2048 and times > 0
        for length in own:
            used[length] += times
    assert used == Counter(histogram)
    sequences = sum(t for _, t in got)
    assert sequences <= lengths.sum() / 2048 * 1.0005 + 1
    # The patterns, not the residual packing, place most pieces.
    assert len(got) < 20_000


def test_patterns_and_solver():
    index = packing.patterns(np.array([1, 2, 3, 4, 6]), 6)
    found = sorted(tuple(sorted(np.array([1, 2, 3, 4, 6])[p[p >= 0]].tolist())) for p in index)
    assert found == [(1, 1, 4), (1, 2, 3), (2, 2, 2), (2, 4), (3, 3), (6,)]
    x = packing.nnls(index, np.array([0.0, 5, 0, 5, 7]), np.ones(5), 500)
    assert np.allclose(sorted(x.round(2)), [0, 0, 0, 0, 5, 7], atol=0.1)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    docs = [(k if k % 5 else None, rng.integers(0, 2**bits, rng.integers(0, 90), dtype=np.uint64).astype(np.uint32)) for k in range(40)]
    own = tokenfile.TokenFile(tokenfile.write_file(docs, bits, block_ids=37))
    assert own.nulls.tolist() == [k % 5 == 0 for k in range(40)]
    for k, (_, ids) in enumerate(docs):
        assert own.document(k).tolist() == ids.tolist()
    every = np.concatenate([d[1] for d in docs])
    assert own.ids(50, 333).tolist() == every[50:333].tolist()
    assert tokenfile.TokenFile(tokenfile.write_file([], bits)).n_ids == 0


def test_fewest_bits():
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def test_token_files(spark, sf_dir, tokenizer):
    def want(rows):
        out, start = [], 0
        for d, t in rows:
            ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        return out

    rows = sorted((r["doc_id"], r["text"]) for r in util.documents(sf_dir))
    got = REGISTRY["op8_token_files"](spark, sf_dir).orderBy("start").collect()
    assert [tuple(r) for r in got] == want(rows)


def test_token_files_odd(spark, tmp_path, tokenizer):
    out = str(tmp_path / "files")
    tokenfile.write_tokens(util.odd(spark), out, PATH, 1, ids_per_file=500, docs_per_part=3)
    got = tokenfile.read_tokens(spark, out).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1000, 1001, 1002, 1003, 1003, 1004, 1005, 1006]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    texts = {r[0]: r[1] for r in util.ODD}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
    tokenfile.write_tokens(util.empty(spark), out, PATH, 1)
    assert tokenfile.read_tokens(spark, out).count() == 0


@pytest.mark.parametrize("remembered", [50, 400_000])
def test_word_ids_equal_the_library_with_special_strings(remembered):
    rnd = random.Random(remembered)
    parts = ["a", "The", "é", " ", "  ", "\n", "'s", "1", "!", "ß", "日本", "́", "end.", "end,", "End!!", "x.y.", "<|endoftext|>", "<|startoftext|>", "<|endof"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    library, own, got = Tokenizer.from_file(PATH), tokens.WordIds(PATH, remembered), []
    for _, _, data, offsets in slices(pa.array(texts), 2_000):
        ids, counts = own.encode(data, offsets, 7)
        got += np.split(ids, np.cumsum(counts)[:-1])
    assert [g.tolist() for g in got] == [[*e.ids, 7] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(own.known.hashes) < 50 + 500 or remembered > 50
