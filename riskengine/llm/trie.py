"""BPE encoding over a trie of distinct words, and decoding.

The encoding of a word is fixed by its last token and the encoding of what stands before that token. So every node of a
trie of words needs one figure, its *last token*: among the tokens that end there, the one that can stand after the last
token of the node where it begins. Words are put in byte order, which lists their trie depth-first: a word keeps the
nodes of the prefix that it shares with the word before it and adds its own, so a shared prefix is worked out once,
whatever number of words goes on from it. A word's tokens are then read from its last node backwards.

Which tokens end at a node comes from an automaton over the vocabulary whose state goes down the trie with the last
token. Whether a token can stand after another is found once per pair: while both are built up from bytes, no merge
across their border may come before the merge that consumes one of its sides.

Texts are taken a slice at a time; the words are the matches of the pattern in the slice's distinct chunks, and chunks
and words are remembered per worker in two generations of bounded size. The tokenizer's added tokens are found in a text
first and stand for themselves, as in the library.

Rules for odd input: a null text counts as empty and gives no ids; repeated rows are encoded alike, ties cannot arise;
result columns replace input columns of the same name, others pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskengine.llm.bpe import chunk_starts
from riskengine.llm.common import Pieces, clashing, distinct_spans, list_column, per_group, slices
from riskengine.llm.tokens import byte_alphabet

#: Fixed value: how the byte-level pre-tokenizer cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 120_000
#: Steps and pairs that are kept before they are worked out anew.
KEPT_STEPS = 400_000


class Vocabulary:
    """Tokens of a byte-level tokenizer file, how each is merged, and its added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        plain = not spec.get("normalizer") and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if splitter.get("type") != "ByteLevel" or decoder.get("type") != "ByteLevel" or not plain or any(model.get(o) for o in options):
            raise ValueError("not a plain byte-level tokenizer")
        back = {chr(c): b for b, c in byte_alphabet().items()}
        self.ids = {bytes(back[c] for c in token): i for token, i in model["vocab"].items()}
        self.added = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens with options of their own")
        top = max([*self.ids.values(), *self.added.values()])
        #: Pairs of tokens are keyed by ``left * size + right``.
        self.size = top + 1
        self.bytes_of = [b""] * self.size
        for token, i in [*self.ids.items(), *self.added.items()]:
            self.bytes_of[i] = token
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        code = {t: i for t, i in model["vocab"].items()}
        #: The rank of the merge of two tokens.
        self.rank: dict[int, int] = {}
        #: For each token its right and left edges: the tokens that stand there while it is built up, each with the
        #: rank at which it is consumed. A token is built from tokens of lower ranks, so all is known in file order.
        self.right: dict[int, list[tuple[int, float]]] = {}
        self.left: dict[int, list[tuple[int, float]]] = {}
        never = float("inf")
        for b in range(256):
            i = self.ids[bytes([b])]
            self.right[i] = self.left[i] = [(i, never)]
        for rank, (a, b) in enumerate(pairs):
            self.rank[code[a] * self.size + code[b]] = rank
        self.usable = set(self.right)
        for rank, (a, b) in enumerate(pairs):
            a, b, whole = code[a], code[b], code[a + b]
            if whole in self.right or a not in self.usable or b not in self.usable:
                raise ValueError("a token is merged in two ways or before its parts")
            # Edges up to this merge, then the token itself.
            self.right[whole] = [*((t, rank if end == never else end) for t, end in self.right[b]), (whole, never)]
            self.left[whole] = [*((t, rank if end == never else end) for t, end in self.left[a]), (whole, never)]
            # A pair that an earlier merge parts never comes to be.
            if self.fits(a, b, rank):
                self.usable.add(whole)

    def fits(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether the two tokens stay apart: no merge across the border ranks before what consumes its sides, of equal
        pairs the leftmost first. Only merges ``before`` a rank count."""
        size, rank, starts = self.size, self.rank, self.left[right]
        for x, x_end in self.right[left]:
            row = x * size
            for y, y_end in starts:
                across = rank.get(row + y)
                if across is not None and across < before and across < x_end and across <= y_end:
                    return False
        return True


class Trie:
    """Encodes words depth-first."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        tokens = [(vocabulary.bytes_of[i], i) for i in vocabulary.usable]
        self._tokens = dict(tokens)
        self._prefixes = {token[:n] for token, _ in tokens for n in range(len(token) + 1)}
        self._length = {i: len(token) for token, i in tokens}
        self._restart()
        self._fits: dict[int, bool] = {}

    def _restart(self) -> None:
        self._strings, self._numbers, self._ending, self._steps = [b""], {b"": 0}, [[]], {}

    def _step(self, state: int, byte: int) -> int:
        """The longest ending of the state's string and the byte that begins some token."""
        string = self._strings[state] + bytes([byte])
        while string not in self._prefixes:
            string = string[1:]
        number = self._numbers.get(string)
        if number is None:
            number = self._numbers[string] = len(self._strings)
            self._strings.append(string)
            endings = (string[n:] for n in range(len(string)))
            self._ending.append([(self._tokens[e], len(e)) for e in endings if e in self._tokens])
        self._steps[state << 8 | byte] = number
        return number

    def encode(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """The ids of each word."""
        if len(self._steps) > KEPT_STEPS:
            self._restart()
        if len(self._fits) > KEPT_STEPS:
            self._fits.clear()
        size, length, known, fits = self.vocabulary.size, self._length, self._fits, self.vocabulary.fits
        out: dict[bytes, list[int]] = {}
        # The nodes from the root to where the walk stands: the automaton's state and the last token of each.
        states, lasts, before = [0], [-1], b""
        for word in sorted(words):
            shared = _shared(before, word)
            del states[shared + 1 :], lasts[shared + 1 :]
            state = states[shared]
            for depth in range(shared + 1, len(word) + 1):
                byte = word[depth - 1]
                following = self._steps.get(state << 8 | byte)
                state = self._step(state, byte) if following is None else following
                for token, n in self._ending[state]:
                    if n == depth:
                        break
                    pair = lasts[depth - n] * size + token
                    apart = known.get(pair)
                    if apart is None:
                        apart = known[pair] = fits(lasts[depth - n], token)
                    if apart:
                        break
                states.append(state)
                lasts.append(token)
            ids, depth = [], len(word)
            while depth:
                ids.append(lasts[depth])
                depth -= length[lasts[depth]]
            ids.reverse()
            out[word] = ids
            before = word
        return out


def _shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    most, at, step = min(len(a), len(b)), 0, 64
    while at + step <= most and a[at : at + step] == b[at : at + step]:
        at += step
    while at < most and a[at] == b[at]:
        at += 1
    return at


class Encoder:
    """Texts to ids by slices."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.vocabulary = Vocabulary(path)
        self.trie = Trie(self.vocabulary)
        self.pattern = regex.compile(PATTERN)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = regex.compile(b"|".join(regex.escape(t) for t in added)) if added else None
        self.remembered, self.young, self.old = remembered, {}, {}

    def _known(self, part: bytes) -> bool:
        if part in self.young:
            return True
        ids = self.old.get(part)
        if ids is not None:
            self.young[part] = ids
        return ids is not None

    def learn(self, chunks: list[bytes]) -> None:
        """Sees to it that every chunk is remembered."""
        young, findall = self.young, self.pattern.findall
        new = [c for c in chunks if not self._known(c)]
        cut = [[m.encode() for m in findall(c.decode("utf-8", "replace"))] for c in new]
        words = {w for parts in cut for w in parts}
        for word, ids in self.trie.encode(w for w in words if not self._known(w)).items():
            young[word] = np.array(ids, np.int32).tobytes()
        for chunk, parts in zip(new, cut):
            if len(parts) != 1:
                young[chunk] = b"".join([young[p] for p in parts])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a slice one after another, and how many each has."""
        starts = chunk_starts(data, offsets)
        added = self._added(data, offsets)
        if added:
            # What lies within an added token begins no chunk; the token and what follows it do.
            edge = np.zeros(len(data) + 1, bool)
            edge[starts] = True
            for a, b in added:
                edge[a:b] = False
                edge[a] = edge[b] = True
            starts = np.flatnonzero(edge[:-1])
        ends = np.append(starts[1:], len(data))
        special = np.isin(starts, [a for a, _ in added])
        chunks, which = distinct_spans(data, starts[~special], ends[~special])
        self.learn(chunks)
        found = [self.young[c] for c in chunks]
        order = np.empty(len(starts), np.int64)
        order[~special] = which
        if added:
            order[special] = len(found) + np.arange(len(added))
            found += [np.int32(self.vocabulary.added[data[a:b].tobytes()]).tobytes() for a, b in added]
        if len(self.young) > self.remembered:
            self.young, self.old = {}, self.young
        pieces = Pieces(np.frombuffer(b"".join(found), np.int32), np.fromiter(map(len, found), np.int64, len(found)) // 4)
        ids, counts = pieces.gather(order)
        docs = np.searchsorted(offsets, starts, "right") - 1
        return ids, per_group(counts, docs, len(offsets) - 1)

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens stand, none across documents."""
        if self.added is None or not self.added.search(whole := data.tobytes()):
            return []
        return [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in self.added.finditer(whole, a, b)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=1)
def token_table(path: str) -> Pieces:
    """The bytes of each id."""
    table = Vocabulary(path).bytes_of
    return Pieces(np.frombuffer(b"".join(table), np.uint8), np.array([len(t) for t in table]))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``, an array of token ids; the text column is dropped."""
    kept = clashing(docs, [ids]).withColumnRenamed(text, "_text")
    schema = T.StructType([f for f in kept.schema if f.name != "_text"] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        own = encoder(path)
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            for first, end, data, offsets in slices(batch.column(at)):
                rest = [batch.column(i).slice(first, end - first) for i in range(batch.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, list_column(*own.encode(data, offsets), pa.int32())], names=[*names, ids])

    return kept.mapInArrow(run, schema)


def decoded_rows(column: pa.ListArray, table: Pieces) -> Iterable[tuple[np.ndarray, bytes]]:
    """The ids of each row and the text that they stand for, in UTF-8; bytes that are no text become U+FFFD."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        whole = table.gather(values[a:b])[0].tobytes()
        yield values[a:b], whole.decode("utf-8", "replace").encode()


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text that the ids stand for, added tokens included."""
    kept = clashing(encoded, [out])
    schema = T.StructType([*kept.schema, T.StructField(out, T.StringType(), False)])

    def run(batches):
        table = token_table(path)
        for batch in batches:
            texts = [t for _, t in decoded_rows(batch.column(batch.schema.get_field_index(ids)), table)]
            column = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def digests(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Decodes and keeps ``n_tokens`` and the SHA-256 of the ids, as little-endian 32-bit numbers, and of the text."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = clashing(encoded, names)
    rest = [f for f in kept.schema if f.name != ids]
    kinds = [T.LongType(), T.StringType(), T.StringType()]
    schema = T.StructType(rest + [T.StructField(n, k, False) for n, k in zip(names, kinds)])

    def run(batches):
        table = token_table(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            found = [
                (len(own), hashlib.sha256(own.astype("<u4")).hexdigest(), hashlib.sha256(text).hexdigest())
                for own, text in decoded_rows(column, table)
            ]
            new = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string()))]
            left = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*left, *new], names=schema.names)

    return kept.mapInArrow(run, schema)
