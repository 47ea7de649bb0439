"""Ids of a public tokenizer for whole texts, by looking up each word once.

For a tokenizer that drops white space, a text's ids are those of its words between ASCII white space, one after
another. Words seen before are remembered per worker, a bounded number of them, as flat arrays found by 64-bit hash and
length. A text that holds one of the tokenizer's special strings is handed to the library whole, which gives their ids.

A new word is cut before its closing punctuation, which the tokenizer's pattern cuts off too, so "end," and "end." share
what is known of "end". A word of lower-case letters in composed form passes the tokenizer's normalizer and pattern
unchanged and whole; it is handed to the tokenizer's merges directly, in the byte alphabet they are written in.
"""

from __future__ import annotations

import ctypes
import gc
import os
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from riskengine.llm.common import Hashes, lower, per_group, words_of

REMEMBERED = 400_000
_CLOSING = b".,;:!?%&*#$"
#: Marks that join with an ASCII letter are written with these bytes first.
_MARKS = (0xCC, 0xCD)


def byte_alphabet() -> dict[int, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it is printable in
    Latin-1, else the next one from U+0100 on."""
    table, following = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            table[b] = b
        else:
            table[b], following = following, following + 1
    return table


class Known:
    """Words and their ids as flat arrays, found by hash and length; no word is kept as an object.

    ``ids[0]`` is free for the caller. Beyond ``limit`` words, the half that was not looked up for longest goes.
    """

    def __init__(self, limit: int):
        self.limit, self.now = limit, 0
        self.hashes = np.zeros(0, np.uint64)
        self.sizes, self.counts, self.used = (np.zeros(0, np.int32) for _ in range(3))
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(1, np.uint32)

    def find(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of words, -1 for those not known."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.sizes[at] == sizes), at, -1)

    def add(self, hashes: np.ndarray, sizes: np.ndarray, ids: list[bytes]) -> None:
        """New words, each once. A word whose hash is taken is left out."""
        order = np.argsort(hashes, kind="stable")
        order = order[np.diff(hashes[order], prepend=hashes[order[:1]] + np.uint64(1)) != 0]
        if len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
            order = order[self.hashes[near] != hashes[order]]
        counts = np.array([len(ids[i]) // 4 for i in order], np.int32)
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join([ids[i] for i in order]), "<u4")])
        at = np.searchsorted(self.hashes, hashes[order])
        stamp = np.full(len(order), self.now, np.int32)
        for name, values in (("hashes", hashes[order]), ("sizes", sizes[order]), ("counts", counts), ("starts", starts), ("used", stamp)):
            own = getattr(self, name)
            setattr(self, name, np.insert(own, at, values.astype(own.dtype)))

    def forget(self) -> None:
        if len(self.hashes) <= self.limit:
            return
        kept = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
        flat, counts = _gather(self.ids, self.starts[kept], self.counts[kept])
        self.hashes, self.sizes, self.used, self.counts = (c[kept] for c in (self.hashes, self.sizes, self.used, self.counts))
        self.ids = np.concatenate([self.ids[:1], flat])
        self.starts = 1 + np.cumsum(counts, dtype=np.int64) - counts


def _gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces at ``starts`` one after another."""
    counts = counts.astype(np.int64)
    ends = np.cumsum(counts)
    at = np.repeat(starts - (ends - counts), counts)
    at += np.arange(int(ends[-1]) if len(ends) else 0)
    return values[at], counts


def _hashed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *map(len, words)])
    return Hashes(np.frombuffer(b"".join(words), np.uint8)).spans(ends[:-1], ends[1:]), np.diff(ends)


class WordIds:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.alphabet = Tokenizer(self.tokenizer.model), byte_alphabet()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(remembered)

    def learn(self, words: list[bytes]) -> None:
        """Sees to it that every word is known. None of them is so far."""
        whole, split = [], []
        for word in words:
            core = word.rstrip(_CLOSING)
            if core and len(core) < len(word) and core[-1:].isalnum():
                split.append((word, core, word[len(core) :]))
            else:
                whole.append(word)
        ids = self._learn_whole(list({*whole, *(c for _, c, _ in split), *(t for _, _, t in split)}))
        if split:
            self.known.add(*_hashed([w for w, _, _ in split]), [ids[c] + ids[t] for _, c, t in split])

    def _learn_whole(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of the words, which are known afterwards."""
        known, out, plain, other = self.known, {}, [], []
        hashes, sizes = _hashed(words)
        places = known.find(hashes, sizes).tolist()
        for word, at in zip(words, places):
            if at >= 0:
                out[word] = known.ids[known.starts[at] : known.starts[at] + known.counts[at]].tobytes()
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                plain.append((word, word.decode("latin-1").translate(self.alphabet)))
            else:
                other.append((word, text))
        for own, pairs in ((self.merges, plain), (self.tokenizer, other)):
            for first in range(0, len(pairs), 20_000):
                part = pairs[first : first + 20_000]
                found = own.encode_batch_fast([p[1] for p in part], add_special_tokens=False)
                for (word, _), e in zip(part, found):
                    out[word] = np.array(e.ids, "<u4").tobytes()
        new = np.array(places) < 0
        if new.any():
            known.add(hashes[new], sizes[new], [out[w] for w, n in zip(words, new.tolist()) if n])
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a slice, each with the end id, one after another; and how many each has."""
        n, known = len(offsets) - 1, self.known
        small = lower(data)
        marked = np.flatnonzero((data == _MARKS[0]) | (data == _MARKS[1]))
        for d in np.unique(np.searchsorted(offsets, marked, "right") - 1):
            small[offsets[d] : offsets[d + 1]] = data[offsets[d] : offsets[d + 1]]
        starts, ends, docs = words_of(small, offsets)
        entire = self._with_special(data, offsets)
        if entire:
            apart = np.isin(docs, list(entire))
            starts, ends, docs = starts[~apart], ends[~apart], docs[~apart]
        hashes, index, which = np.unique(Hashes(small).spans(starts, ends), return_index=True, return_inverse=True)
        sizes = (ends - starts)[index]
        known.now += 1
        known.forget()
        place = known.find(hashes, sizes)
        new = np.flatnonzero(place < 0)
        if len(new):
            text = small.tobytes()
            self.learn([text[a:b] for a, b in zip(starts[index[new]].tolist(), ends[index[new]].tolist())])
            place = known.find(hashes, sizes)
        known.used[place] = known.now
        # After the words of each document comes the end id; documents with special strings are one piece each.
        values, firsts, counts = known.ids, np.append(known.starts, 0), np.append(known.counts, 1)
        values[0] = end
        which = place[which]
        if entire:
            extra = np.cumsum([0, *map(len, entire.values())])
            firsts, counts = np.append(firsts, len(values) + extra[:-1]), np.append(counts, np.diff(extra))
            values = np.concatenate([values, *entire.values()])
            at = np.searchsorted(docs, list(entire))
            which = np.insert(which, at, len(known.starts) + 1 + np.arange(len(entire)))
            docs = np.insert(docs, at, list(entire))
        order = np.full(len(which) + n, len(known.starts))
        order[np.arange(len(which)) + docs] = which
        owner = np.empty(len(order), np.int64)
        owner[np.arange(len(which)) + docs] = docs
        owner[np.cumsum(np.bincount(docs, minlength=n)) + np.arange(n)] = np.arange(n)
        ids, number = _gather(values, firsts[order], counts[order])
        return ids, per_group(number, owner, n)

    def _with_special(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """Ids of the documents that hold a special string, as the library gives them for the entire text."""
        text = data.tobytes()
        if not any(s in text for s in self.special):
            return {}
        out = {}
        for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if any(text.find(s, a, b) >= 0 for s in self.special):
                out[d] = np.array(self.tokenizer.encode(text[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        return out


def release() -> None:
    """Gives memory that earlier work of this process no longer uses back to the system. Workers are used again for later
    stages, so a stage would else begin on top of what the one before it has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # other C libraries return memory by themselves
        pass


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def vocabulary(path: str) -> int:
    """The number of ids of the tokenizer."""
    return word_ids(path).tokenizer.get_vocab_size()
