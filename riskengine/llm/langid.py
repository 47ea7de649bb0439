"""Language of texts by a linear-chain conditional random field over their words.

A word is a run of ASCII letters and non-ASCII bytes, A-Z lower-cased. Its features are its first one to three bytes,
its last one to four, all n-grams of two to four bytes, the whole word, and the languages in whose lexicon it stands; a
lexicon holds the words of the training sample that are mostly of one language. Features are hashed into ``2**BITS``
rows of weights, one column per language. Words form chains of ``CHAIN`` in the order of the text; learned transitions
join neighbours. Forward-backward gives each word's probabilities, so parts in different languages get labels of their
own; a text's score for a language is the mean over its words. ``familiar`` is the share of its three-byte
grams, word by word with a mark at both ends, that stand in at least two words of the sample, against that share over the
sample itself, at most 1. Unlike the score, which is a probability among the learned languages, it is low for any other
language and for junk. ``n_grams`` is how many grams were looked at.

The model is fitted on at most ``SAMPLE`` labelled rows, the first by a hash of id and text. Prediction reads the text
alone and reads all of it.

Rules for odd input: a null text and a text without a letter are ``und`` with score 0; without any labelled training
row every text is; a null id belongs to the training part; a null label never trains. ``familiar`` is 0 for a text without
words and 1 for any other where the sample has fewer than ``LEAST_GRAMS`` familiar grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.llm.common import Hashes, clashing, distinct_spans, lower, per_group, remainder, slices, spans_of

UNDETERMINED = "und"
SAMPLE, BITS, CHAIN = 800, 16, 64
STEPS, RATE = 25, 0.3
LEXICON_COUNT, LEXICON_SHARE = 3, 0.9
#: A gram is familiar if it stands in so many words; a sample with fewer such grams cannot tell what is foreign.
GRAM_WORDS, LEAST_GRAMS = 2, 500
_LETTER = regex.compile(r"\p{L}")
_WORD = np.zeros(256, bool)
_WORD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all words: the word's number and the feature's row; and a hash of each whole word."""
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    owner, every = np.repeat(np.arange(len(words)), size), Hashes(data)
    whole = every.spans(starts, ends)
    who, what = [np.arange(len(words))], [whole]

    def add(rows, hashes, kind):
        who.append(rows)
        what.append(hashes ^ np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64))

    for n in (1, 2, 3):
        rows = np.flatnonzero(size >= n)
        add(rows, every.spans(starts[rows], starts[rows] + n), n)
    for n in (1, 2, 3, 4):
        rows = np.flatnonzero(size >= n)
        add(rows, every.spans(ends[rows] - n, ends[rows]), 10 + n)
    for n in (2, 3, 4):
        grams = every.grams(n)
        inside = np.flatnonzero(owner[: len(grams)] == owner[n - 1 :]) if len(grams) else np.zeros(0, np.int64)
        add(owner[inside], grams[inside], 20 + n)
    return np.concatenate(who), (np.concatenate(what) & np.uint64((1 << BITS) - 1)).astype(np.int64), whole


def marked_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all three-byte grams of `` word ``, one word after another, and each one's word."""
    data = np.frombuffer(b"".join(b" %s " % w for w in words), np.uint8)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    return Hashes(data).grams(3)[inside], owner[inside]


class Crf:
    """Weights of features and transitions, the lexicon as sorted word hashes with the language of each, and the hashes
    of familiar grams, sorted."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.weights = np.zeros((1 << BITS, k))
        self.lexical = np.zeros((k, k))
        self.moves = np.zeros((k, k))
        self.first = np.zeros(k)
        self.lexicon, self.lexicon_language = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.grams, self.usual = np.zeros(0, np.uint64), 0.0

    def in_lexicon(self, whole: np.ndarray) -> np.ndarray:
        """The language of the lexicon that holds each word, or -1."""
        if not len(self.lexicon):
            return np.full(len(whole), -1)
        at = np.minimum(np.searchsorted(self.lexicon, whole), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == whole, self.lexicon_language[at], -1)

    def familiar(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the number of its grams that are familiar, and of all."""
        grams, owner = marked_grams(words)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        good = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), bool)
        return per_group(good, owner, len(words)), np.bincount(owner, minlength=len(words))

    def emissions(self, who: np.ndarray, what: np.ndarray, lexicon: np.ndarray, n: int) -> np.ndarray:
        out = np.stack([np.bincount(who, self.weights[what, k], n) for k in range(len(self.languages))], 1)
        out /= np.sqrt(np.maximum(1, np.bincount(who, minlength=n)))[:, None]
        return out + np.where(lexicon[:, None] >= 0, self.lexical[lexicon], 0)

    def marginals(self, emissions: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over all chains at once. ``words`` is (chain, step), -1 beyond a chain's end. Gives the
        probabilities (chain, step, language) and the expected transitions."""
        chains, steps = words.shape
        k = len(self.languages)
        e = np.exp(emissions - emissions.max(1, keepdims=True)) if len(emissions) else emissions
        e = np.concatenate([e, np.ones((1, k))])
        moves = np.exp(self.moves - self.moves.max())
        forward, back = np.empty((steps, chains, k)), np.empty((steps, chains, k))
        now = np.exp(self.first - self.first.max()) * e[words[:, 0]]
        forward[0] = now / now.sum(1, keepdims=True)
        for t in range(1, steps):
            now = (forward[t - 1] @ moves) * e[words[:, t]]
            forward[t] = np.where((t < lengths)[:, None], now / now.sum(1, keepdims=True), forward[t - 1])
        back[-1] = 1
        expected = np.zeros((k, k))
        for t in range(steps - 2, -1, -1):
            inner = e[words[:, t + 1]] * back[t + 1]
            now = inner @ moves.T
            live = (t + 1 < lengths)[:, None]
            back[t] = np.where(live, now / now.sum(1, keepdims=True), 1)
            joint = forward[t][:, :, None] * moves[None] * inner[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            expected += (joint * live[:, :, None]).sum(0)
        out = forward * back
        return np.moveaxis(out / out.sum(2, keepdims=True), 0, 1), expected

    def fit(self, words: list[bytes], chains: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> None:
        """Full-batch adaptive gradient steps on the likelihood; ``label`` is the language of each chain."""
        k, n = len(self.languages), len(words)
        used = chains >= 0
        token, gold = chains[used], np.repeat(label, lengths)
        counts = np.zeros((n, k))
        np.add.at(counts, (token, gold), 1)
        who, what, whole = features(words)
        total = counts.sum(1)
        listed = (total >= LEXICON_COUNT) & (counts.max(1) >= LEXICON_SHARE * total)
        order = np.argsort(whole[listed])
        self.lexicon, self.lexicon_language = whole[listed][order], counts[listed].argmax(1)[order]
        lexicon = self.in_lexicon(whole)
        grams, owner = marked_grams(words)
        pairs = np.unique(np.stack([grams, owner.astype(np.uint64)]), axis=1)[0]
        self.grams, times = np.unique(pairs, return_counts=True)
        self.grams = self.grams[times >= GRAM_WORDS]
        seen, every = self.familiar(words)
        if len(self.grams) >= LEAST_GRAMS:
            self.usual = float((seen * total).sum() / max(1, (every * total).sum()))
        scale = 1 / np.sqrt(np.maximum(1, np.bincount(who, minlength=n)))
        moved = np.zeros((k, k))
        np.add.at(moved, (label, label), lengths - 1)
        began = np.bincount(label, minlength=k)
        parts = [self.weights, self.lexical, self.moves, self.first]
        sums = [np.full(p.shape, 1e-8) for p in parts]
        for _ in range(STEPS):
            p, expected = self.marginals(self.emissions(who, what, lexicon, n), chains, lengths)
            seen = np.stack([np.bincount(token, p[used][:, j], n) for j in range(k)], 1)
            slope = (counts - seen) * scale[:, None]
            by_row = np.stack([np.bincount(what, slope[who, j], 1 << BITS) for j in range(k)], 1)
            by_lexicon = np.stack([(counts - seen)[lexicon == j].sum(0) for j in range(k)])
            slopes = [by_row, by_lexicon, moved - expected, began - p[:, 0].sum(0)]
            for own, square, g in zip(parts, sums, slopes):
                g = g - 1e-3 * own
                square += g * g
                own += RATE * g / np.sqrt(square)


def _chains(which: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in text order as rows of at most ``CHAIN``; the lengths of the rows and their documents."""
    count = np.bincount(docs, minlength=n_docs)
    rows = -(-count // CHAIN)
    at = np.arange(len(which)) - (np.cumsum(count) - count)[docs]
    row = (np.cumsum(rows) - rows)[docs] + at // CHAIN
    out = np.full((int(rows.sum()), CHAIN), -1)
    out[row, at % CHAIN] = which
    return out, np.bincount(row, minlength=len(out)), np.repeat(np.arange(n_docs), rows)


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a slice, and for each word in order its number and its document."""
    small = lower(data)
    starts, ends, docs = spans_of(_WORD[small], offsets)
    words, which = distinct_spans(small, starts, ends)
    return words, which, docs


def fit(docs: DataFrame, sample: int = SAMPLE) -> Crf | None:
    """Learns from at most ``sample`` rows of ``text`` and ``lang``; None if there are no labelled words."""
    good = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang", F.xxhash64("doc_id", "text").alias("_h"))
    # Which hash comes last is found from the hashes alone, so a task sends none but the sample's own texts.
    last = good.select("_h").orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    rows = good.filter(F.col("_h") <= F.lit(last).cast("long")).orderBy("_h", "lang").limit(sample).collect()
    languages = sorted({r.lang for r in rows})
    column = pa.array([r.text for r in rows], pa.string())
    numbers: dict[bytes, int] = {}
    chains, lengths, labels = [], [], []
    for first, end, data, offsets in slices(column):
        words, which, owner = words_in(data, offsets)
        known = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        rows_, own, doc = _chains(known[which] if len(words) else which, owner, end - first)
        label = np.array([languages.index(r.lang) for r in rows[first:end]], np.int64)
        chains.append(rows_), lengths.append(own), labels.append(label[doc])
    if not numbers:
        return None
    model = Crf(languages)
    model.fit(list(numbers), np.concatenate(chains), np.concatenate(lengths), np.concatenate(labels))
    return model


def label_words(model: Crf, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word of a slice, in order: the probabilities of each language, the numbers of its familiar and of all
    its grams, and its document."""
    words, which, docs = words_in(data, offsets)
    if not len(which):
        return np.zeros((0, len(model.languages))), which, which, docs
    who, what, whole = features(words)
    emissions = model.emissions(who, what, model.in_lexicon(whole), len(words))
    chains, lengths, _ = _chains(which, docs, len(offsets) - 1)
    p, _ = model.marginals(emissions, chains, lengths)
    seen, grams = model.familiar(words)
    return p[chains >= 0], seen[which], grams[which], docs


def predict(docs: DataFrame, model: Crf | None) -> DataFrame:
    """Adds ``lang_pred``, ``score``, ``familiar`` and ``n_grams`` from the text alone."""
    kept = clashing(docs, ["lang_pred", "score", "familiar", "n_grams"])
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("familiar", T.DoubleType()), ("n_grams", T.LongType())]
    schema = T.StructType([*kept.schema, *[T.StructField(*a) for a in added]])

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for first, end, data, offsets in slices(text):
                n, out, score = end - first, [UNDETERMINED] * (end - first), np.zeros(end - first)
                familiar, grams = np.zeros(n), np.zeros(n, np.int64)
                if model is not None:
                    p, seen, all_, docs_ = label_words(model, data, offsets)
                    count = np.bincount(docs_, minlength=n)
                    grams = per_group(all_, docs_, n)
                    familiar = per_group(seen, docs_, n) / np.maximum(1, grams * model.usual) if model.usual else np.ones(n)
                    familiar = np.where(grams > 0, np.minimum(1.0, familiar), 0.0)
                    means = np.stack([np.bincount(docs_, p[:, k], n) for k in range(len(model.languages))], 1) / np.maximum(1, count)[:, None]
                    ascii_letters = np.bincount(np.searchsorted(offsets, np.flatnonzero(_WORD[data] & (data < 128)), "right") - 1, minlength=n)
                    for d in np.flatnonzero(count):
                        if ascii_letters[d] or _LETTER.search(data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")):
                            out[d], score[d] = model.languages[means[d].argmax()], min(1.0, means[d].max())
                rest = [c.slice(first, n) for c in batch.columns]
                found = [pa.array(out, pa.string()), pa.array(score), pa.array(familiar), pa.array(grams)]
                yield pa.RecordBatch.from_arrays([*rest, *found], names=schema.names)

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """Adds ``held_out`` (crc32 of the id modulo ``folds`` is ``held``), ``lang_pred``, ``score``, ``familiar`` and
    ``n_grams``; learns from the other rows."""
    marked = clashing(docs, ["held_out"]).withColumn("held_out", F.coalesce(remainder(docs, "doc_id", folds) == held, F.lit(False)))
    return predict(marked, fit(marked.filter("NOT held_out"), sample))
