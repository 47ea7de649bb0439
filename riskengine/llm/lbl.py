"""Scores of texts by a log-bilinear neural language model, trained with noise-contrastive estimation.

A token's probability is that of its class given the classes of the ``CONTEXT`` tokens before it, times that of the
word within its class. The ``FREQUENT`` most frequent words are classes of their own, the end of a text is one, and all
other words are dealt to classes by a hash of their last three bytes, which tell language and part of speech. The
classes are predicted by the log-bilinear model: every position of the context has a table of class vectors (the
position's matrix times the class's vector), their sum is the predicted vector, and its products with the target
vectors plus a bias are normalised over all classes, as one matrix product per batch. Within a class, a word has
(c + 0.5) / (sum over the class of (c + 0.5), and 0.5 for words never seen).

All training documents take part: words are counted over the corpus, and every task trains a model on its documents in
one pass, starting from the corpus's class frequencies; the models are averaged, weighted by tokens, with an
aggregate per parameter.

Counts of the most frequent words, at most ``HEAD`` (a bound on what is sent to tasks), are looked up while scoring. All
other words are joined with the counts by word, so no word is left out at any size of the corpus.

Rules for odd input: a null text is empty and has the end token alone; a null id belongs to the training part; repeated
rows are scored one by one; without training tokens all counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import Hashes, distinct_spans, lower, mix, remainder, slices, words_of, written

FREQUENT, SUFFIXES, CONTEXT, WIDTH = 47, 80, 4, 16
CLASSES = 1 + FREQUENT + SUFFIXES
HEAD = 150_000
LEVELS = 16  # levels of frequency per doubling
NOISE, BATCH, RATE, SEED = 64, 4096, 0.1, 20240101
END = b""


def suffix_classes(words: list[bytes]) -> np.ndarray:
    """The class of each word by its last three bytes."""
    if not words:
        return np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = Hashes(data).spans(np.maximum(ends - [len(w) for w in words], ends - 3), ends)
    return 1 + FREQUENT + (mix(hashes) % np.uint64(SUFFIXES)).astype(np.int64)


class Vocabulary:
    """Counts of the most frequent words, the classes, and the totals of the corpus."""

    def __init__(self, head: list[tuple[bytes, int]], ends: int, tokens: int, distinct: int):
        self.counts = dict(head)
        self.frequent = {w: 1 + i for i, (w, _) in enumerate(head[:FREQUENT])}
        self.ends, self.tokens, self.distinct = ends, tokens, distinct
        self.mass = np.zeros(CLASSES)  # of each class, the sum of c + 0.5

    def classes(self, words: list[bytes]) -> np.ndarray:
        out = suffix_classes(words)
        for i, w in enumerate(words):
            own = self.frequent.get(w)
            if own is not None:
                out[i] = own
        return out

    def shares(self) -> np.ndarray:
        return self.mass / self.mass.sum()


class LogBilinear:
    def __init__(self, shares: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.context = (rng.normal(size=(CONTEXT, CLASSES, WIDTH)) * 0.1).astype(np.float32)
        self.target = (rng.normal(size=(CLASSES, WIDTH)) * 0.1).astype(np.float32)
        self.bias = np.log(shares).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.target.ravel(), self.bias])

    def load(self, flat: np.ndarray) -> None:
        a, b = self.context.size, self.context.size + self.target.size
        self.context = flat[:a].reshape(self.context.shape).astype(np.float32)
        self.target = flat[a:b].reshape(self.target.shape).astype(np.float32)
        self.bias = flat[b:].astype(np.float32)

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """The predicted vectors for rows of context classes."""
        return sum(self.context[i][before[:, i]] for i in range(CONTEXT))

    def log_probabilities(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """log10 of the probability of each class given its context, normalised over all classes."""
        out = np.empty(len(token))
        for a in range(0, len(token), BATCH):
            scores = self.predicted(before[a : a + BATCH]) @ self.target.T + self.bias
            scores -= scores.max(1, keepdims=True)
            own = scores[np.arange(len(scores)), token[a : a + BATCH]]
            out[a : a + BATCH] = own - np.log(np.exp(scores).sum(1))
        return out / np.log(10)

    def train(self, before: np.ndarray, token: np.ndarray, shares: np.ndarray, sums: list[np.ndarray], rng) -> None:
        """One pass: each batch tells its tokens from ``NOISE`` classes drawn by their shares."""
        log_noise = np.log(NOISE * shares).astype(np.float32)
        for a in range(0, len(token), BATCH):
            own, ctx = token[a : a + BATCH], before[a : a + BATCH]
            noise = rng.choice(CLASSES, NOISE, p=shares)
            q = self.predicted(ctx)
            true = (q * self.target[own]).sum(1) + self.bias[own] - log_noise[own]
            false = q @ self.target[noise].T + self.bias[noise] - log_noise[noise]
            up = (1 / (1 + np.exp(np.clip(true, -30, 30)))).astype(np.float32)
            down = (-1 / (1 + np.exp(np.clip(-false, -30, 30)))).astype(np.float32)
            slope = up[:, None] * self.target[own] + down @ self.target[noise]
            to_target = np.zeros_like(self.target)
            np.add.at(to_target, noise, down.T @ q)
            to_target += _scatter(own, up[:, None] * q)
            to_bias = np.bincount(own, up, CLASSES) + np.bincount(noise, down.sum(0), CLASSES)
            to_context = np.stack([_scatter(ctx[:, i], slope) for i in range(CONTEXT)])
            for part, square, g in ((self.context, sums[0], to_context), (self.target, sums[1], to_target), (self.bias, sums[2], to_bias)):
                square += g * g
                part += (RATE * g / np.sqrt(square + 1e-8)).astype(np.float32)


def _scatter(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` by class."""
    at = (rows[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(at, values.ravel(), CLASSES * WIDTH).reshape(CLASSES, WIDTH)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of a slice, the last being the end; for each token in order its number and its document."""
    small, n = lower(data), len(offsets) - 1
    starts, ends, docs = words_of(small, offsets)
    words, which = distinct_spans(small, starts, ends)
    order, owner = np.full(len(which) + n, len(words)), np.empty(len(which) + n, np.int64)
    at = np.arange(len(which)) + docs
    order[at], owner[at] = which, docs
    owner[np.cumsum(np.bincount(docs, minlength=n)) + np.arange(n)] = np.arange(n)
    return [*words, END], order, owner


def contexts(classes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The classes of the tokens before each token; before a text stands its predecessor's end, class 0."""
    out = np.zeros((len(classes), CONTEXT), np.int64)
    for i in range(CONTEXT):
        same = np.zeros(len(classes), bool)
        same[i + 1 :] = docs[i + 1 :] == docs[: -i - 1]
        out[same, i] = classes[: -i - 1][same[i + 1 :]]
    return out


def _classified(vocabulary: Vocabulary, data, offsets):
    words, which, docs = tokens_of(data, offsets)
    of = vocabulary.classes(words[:-1])
    classes = np.append(of, 0)
    return words, which, docs, classes[which], classes


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over the texts; the empty word is the end."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                words, which, _ = tokens_of(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(np.bincount(which, minlength=len(words)))], names=["word", "c"])

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a written table of counts."""
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.length("word") == 0, F.col("c"))).alias("ends")).first()
    # Words are taken by levels of frequency, highest first, as long as a level fits whole; nothing is sorted on one task.
    words = counts.filter(F.length("word") > 0).withColumn("level", F.floor(F.log2("c") * LEVELS))
    least, room = None, HEAD
    for r in sorted(words.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r.n
        if room < 0:
            break
        least = r.level
    rows = words.filter(F.col("level") >= F.lit(least)).select("word", "c").collect()
    head = sorted(((bytes(r.word), r.c) for r in rows), key=lambda wc: (-wc[1], wc[0]))
    out = Vocabulary(head, total.ends or 0, total.n or 0, total.v)

    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            classes = out.classes(words)
            sums = np.bincount(classes, batch.column(1).to_numpy() + 0.5, CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(sums)], names=["class", "mass"])

    found = counts.filter(F.length("word") > 0).mapInArrow(run, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).collect()
    for r in found:
        out.mass[r["class"]] = r.mass
    out.mass[0] = out.ends + 0.5
    out.mass[1 + FREQUENT :] += 0.5
    # Where there are fewer words than classes of their own, the rest stay empty but possible.
    out.mass = np.maximum(out.mass, 0.5)
    return out


def train(docs: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """The average of the models that the tasks fit on their documents."""
    shares = vocabulary.shares()
    model = LogBilinear(shares)

    def run(batches):
        own, rng = LogBilinear(shares), np.random.default_rng(SEED)
        sums = [np.zeros(p.shape) for p in (own.context, own.target, own.bias)]
        seen = 0
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                _, _, owner, token, _ = _classified(vocabulary, data, offsets)
                own.train(contexts(token, owner), token, shares, sums, rng)
                seen += len(token)
        if seen:
            flat = own.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen, np.float64))], names=["i", "x", "w"]
            )

    sums = docs.select("text").mapInArrow(run, "i long, x double, w double").groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x"))
    rows = sums.collect()  # one number per parameter
    if rows:
        flat = np.zeros(len(rows))
        flat[[r.i for r in rows]] = [r.x for r in rows]
        model.load(flat)
    return model


def score(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: LogBilinear) -> DataFrame:
    """Adds n_tokens, n_known, train_tokens, base_score and score to ``doc_id`` and ``held_out``."""
    log_mass = np.log10(vocabulary.mass)
    log_all = float(np.log10(vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)))

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(2)):
                words, which, docs_, token, classes = _classified(vocabulary, data, offsets)
                n = end - first
                known = np.array([vocabulary.counts.get(w, -1) for w in words[:-1]] + [vocabulary.ends], np.float64)
                c = known[which]
                head = c >= 0
                by_class = model.log_probabilities(contexts(token, docs_), token) - log_mass[token]
                rare = np.flatnonzero(~head)
                sizes = np.bincount(docs_[rare], minlength=n)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array([words[i] for i in which[rare].tolist()], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, n) for i in (0, 1)),
                        pa.array(np.bincount(docs_, minlength=n)),
                        pa.array(np.bincount(docs_, head & (c > 0), n).astype(np.int64)),
                        pa.array(np.bincount(docs_, np.where(head, np.log10(np.maximum(c, 0) + 0.5), 0.0), n)),
                        pa.array(np.bincount(docs_, by_class, n)),
                        column,
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_head", "log_head", "log_class", "rare"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, n_head long, log_head double, log_class double, rare array<binary>"
    first = docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)
    first = written(first.withColumn("_row", F.monotonically_increasing_id()), "scored")
    met = first.select("_row", F.explode("rare").alias("word")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = met.groupBy("_row").agg(F.sum(F.log10(c + 0.5)).alias("log_rest"), F.sum((c > 0).cast("long")).alias("n_rest"))
    every = F.col("log_head") + F.coalesce("log_rest", F.lit(0.0))
    return first.drop("rare").join(rest, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (every - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (every + F.col("log_class")).alias("score"),
    )


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """Learns from the rows whose crc32 of the id modulo ``folds`` is not ``held`` and scores all."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(remainder(docs, "doc_id", folds) == held, F.lit(False)).alias("held_out"))
    training = marked.filter("NOT held_out")
    counts = written(count_words(training), "counts")
    words = vocabulary(counts)
    return score(marked, counts, words, train(training, words))
