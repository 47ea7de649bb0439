"""SimHash fingerprints, with DataFrame functions alone.

A text's terms are its pairs of neighbouring words (split at white space, lower-cased; the last word stands alone). A
term weighs as much as its first word has characters, at most ``MOST_WEIGHT``, and votes for or against each of 128 bits
by its hash. A bit is set if the votes for it are more than half of all. Votes are counted in two 32-bit lanes of a
long, so 64 sums hold 128 counters. A document's words never cross the network: they are exploded and summed where the
document is.

Rules for odd input: a null text is empty; a text without words has the fingerprint of zeros; rows equal in id and text
are one document when the next one is looked for, and each gets the same result; a null id (or -2**63, which stands for it)
comes first in the order, and
equal ids go by a hash of the text; a single document is its own next.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import parts_for, row_key, written

MOST_WEIGHT = 15
KEYS_PER_PART = 100_000
BITS = 128
_LANES = 0x0000000100000001


def with_terms(texts: DataFrame, text: str) -> DataFrame:
    """One row per term: adds ``_pos``, ``_term`` (its hash; the low four bits are its weight) and drops the text."""
    words = F.split(F.lower(text), r"\s+")
    weight = lambda w: F.least(F.length(w), F.lit(MOST_WEIGHT)).cast("long")
    terms = F.transform(F.col("_words"), lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1)).bitwiseAND(F.lit(-16)).bitwiseOR(weight(w)))
    split = texts.select(*[c for c in texts.columns if c != text], words.alias("_words"))
    return split.select(*[c for c in split.columns if c != "_words"], F.posexplode(terms).alias("_pos", "_term"))


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and the two longs of the fingerprint, ``f0`` and ``f1``. Each row has keys of its own: a text weighs less
    than 2**31 in all, so the votes of one row, unlike those of many, fit their lanes."""
    weight = F.col("_term").bitwiseAND(F.lit(15))
    rows = with_terms(texts, text).select(
        *keys, weight.alias("_w"), *[F.xxhash64("_term", F.lit(k)).alias(f"_h{k}") for k in (0, 1)]
    )
    votes = [
        F.sum(F.shiftright(f"_h{k}", j).bitwiseAND(F.lit(_LANES)) * F.col("_w")).alias(f"_v{k}_{j}") for k in (0, 1) for j in range(32)
    ]
    sums = rows.groupBy(*keys).agg(F.sum("_w").alias("_all"), *votes)

    def long(k: int) -> Column:
        bits = None
        for j in range(32):
            low, high = F.col(f"_v{k}_{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"_v{k}_{j}", 32)
            for lane, bit in ((low, j), (high, j + 32)):
                value = (1 << bit) - (1 << 64 if bit == 63 else 0)
                one = F.when(lane * 2 > F.col("_all"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long"))
                bits = one if bits is None else bits.bitwiseOR(one)
        return bits

    return sums.select(*keys, long(0).alias("f0"), long(1).alias("f1"))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0))


def likeness(a, b) -> Column:
    """The share of equal bits: 1 for equal fingerprints, about 0.5 for texts that share nothing."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def as_text(f0: Column, f1: Column) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(f), 16, "0")) for f in (f0, f1)])


def within(prints: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """All pairs of distinct fingerprints (a0, a1) < (b0, b1) that differ in at most ``radius`` bits.

    The 128 bits are cut into ``blocks``, more than ``radius`` and a divisor of 128. Two fingerprints within the radius agree on at
    least blocks - radius of them, so for each choice of so many blocks there is a table keyed by these, moved to the
    front, and every such pair meets in one of the tables."""
    if blocks <= radius or BITS % blocks:
        raise ValueError("blocks must be more than the radius and divide 128")
    size = BITS // blocks

    def block(i: int) -> Column:
        first = i * size
        parts = []
        for k, f in ((0, "f0"), (1, "f1")):
            a, b = max(first, 64 * k), min(first + size, 64 * (k + 1))
            if a < b:
                mask = (1 << (b - a)) - 1
                parts.append(F.shiftrightunsigned(f, a - 64 * k).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("long")))
        return F.struct(*parts)

    distinct = prints.select("f0", "f1").distinct()
    tables = [F.struct(F.lit(n).alias("t"), F.xxhash64(*[block(i) for i in chosen]).alias("k")) for n, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    keyed = written(distinct.select("f0", "f1", F.explode(F.array(*tables)).alias("t")).select("f0", "f1", "t.*"), "block-tables")
    a, b = (keyed.select("t", "k", F.col("f0").alias(f"{x}0"), F.col("f1").alias(f"{x}1")) for x in "ab")
    pair = a.join(b, ["t", "k"]).filter("a0 < b0 OR (a0 = b0 AND a1 < b1)")
    near = distance((F.col("a0"), F.col("a1")), (F.col("b0"), F.col("b1")))
    return pair.filter(near <= radius).select("a0", "a1", "b0", "b1", near.alias("distance")).distinct()


def with_next(keys: DataFrame) -> DataFrame:
    """Adds to rows with keys (_k1, _k2) of their own those of the next in order, n1 and n2; after the last comes the first."""
    parts = parts_for(keys.count(), KEYS_PER_PART)
    # Which part a key falls in is written down, so it is the same wherever it is used.
    cut = written(keys.repartitionByRange(parts, "_k1", "_k2").withColumn("_part", F.spark_partition_id()), "key-parts")
    local = Window.partitionBy("_part").orderBy("_k1", "_k2")
    inner = cut.withColumn("_next", F.lead(F.struct("_k1", "_k2")).over(local))
    firsts = cut.groupBy("_part").agg(F.min(F.struct("_k1", "_k2")).alias("_first"))  # one row per part
    every = Window.orderBy("_part")
    begin = F.min("_first").over(Window.partitionBy())
    after = firsts.select("_part", F.coalesce(F.lead("_first").over(every), begin).alias("_after"))
    whole = inner.join(after, "_part").withColumn("_next", F.coalesce("_next", "_after"))
    return whole.select(*keys.columns, F.col("_next._k1").alias("n1"), F.col("_next._k2").alias("n2"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For every document: its size, the text with its last quarter replaced by the beginning of the next document
    (sha256), both fingerprints, and how like they are to each other and to the next document's."""
    text = F.coalesce("text", F.lit(""))
    key = ["_k1", "_k2"]
    rows = docs.select(*row_key(F.col("doc_id"), F.col("text")), text.alias("_text"))
    counted = rows.select(*key, F.length("_text").alias("_n")).groupBy(*key, "_n").agg(F.count(F.lit(1)).alias("copies"))
    following = written(with_next(counted), "following")
    # Equal rows are one text from here on, dropped before the shuffle too. Both joins read this very table, so Spark
    # shuffles the texts once and uses them twice.
    texts = rows.dropDuplicates(key)

    asked = following.select(F.col("_k1").alias("q1"), F.col("_k2").alias("q2"), "n1", "n2", F.floor(F.col("_n") / 4).cast("int").alias("_take"))
    other = texts.select(F.col("_k1").alias("n1"), F.col("_k2").alias("n2"), "_text")
    borrowed = other.join(asked, ["n1", "n2"]).select(F.col("q1").alias("_k1"), F.col("q2").alias("_k2"), F.expr("substring(_text, 1, _take)").alias("_borrowed"))
    n = F.length("_text")
    both = texts.join(borrowed, key).select(
        *key, n.cast("long").alias("n_chars"), "_text",
        F.concat(F.substring("_text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("_borrowed")).alias("_edited"),
    )
    both = both.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    sides = both.select(*key, "n_chars", "edited_sha256", F.posexplode(F.array("_text", "_edited")).alias("_side", "_text"))
    keys = [*key, "n_chars", "edited_sha256"]
    prints = fingerprints(sides, [*keys, "_side"], "_text")
    pick = lambda side, c: F.max(F.when(F.col("_side") == side, F.col(c)))
    found = prints.groupBy(*keys).agg(
        *[pick(s, f"f{k}").alias(f"{name}{k}") for s, name in ((0, "f"), (1, "e")) for k in (0, 1)]
    )
    found = written(found, "fingerprints")
    near = within(found, radius=3)
    # How many other fingerprints lie within three bits: what the block tables find, counted at both ends.
    degrees = near.select(F.explode(F.array(F.struct(F.col("a0").alias("f0"), F.col("a1").alias("f1")), F.struct(F.col("b0").alias("f0"), F.col("b1").alias("f1")))).alias("x"))
    degrees = degrees.groupBy("x.f0", "x.f1").agg(F.count(F.lit(1)).alias("n_near"))
    nexts = found.select(F.col("_k1").alias("n1"), F.col("_k2").alias("n2"), F.col("f0").alias("x0"), F.col("f1").alias("x1"))
    whole = found.join(following.drop("_n"), key).join(nexts, ["n1", "n2"]).join(degrees, ["f0", "f1"], "left")
    own, edited, after = ((F.col(f"{c}0"), F.col(f"{c}1")) for c in "fex")
    return whole.select(
        F.nullif("_k1", F.lit(-(2**63))).alias("doc_id"), "n_chars", "edited_sha256",
        as_text(*own).alias("fingerprint"), as_text(*edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, after).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"), "copies",
    ).withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
