"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm import langid, minhash, packing, suffix
from riskengine.llm.common import written
from riskengine.session import shared_dir

#: A text is rejected if less than this share of its grams is familiar, by more than so many standard deviations of
#: a share of so many grams. Short texts have wide deviations, so they are rejected only for want of any familiar gram.
LEAST_FAMILIAR, DEVIATIONS = 0.8, 6
#: Ids that are made from texts begin here.
_BY_TEXT = 1 << 62


#: The columns that stages read or set; all others are carried along.
_USED = ("doc_id", "text", "lang", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carrying(stage: Stage) -> Stage:
    """The stage with columns it doesn't know under names that no operator uses, and given back as they were."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in _USED else f"_carried_{i}" for i, c in enumerate(docs.columns)}
        # By place: a name may hold a dot or differ from another in case alone.
        out = stage(spark, docs.toDF(*names.values()), sf_dir)
        return out.select(*names.values()).toDF(*names)

    return run


@_carrying
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows. A text goes if it is null, has no letter, or if far fewer of its grams
    are familiar from the labelled texts than of these texts themselves: another language, markup, random letters. A
    label is not looked at, nor is the number of languages. Rows that repeat are judged alike."""
    found = langid.identify(docs)
    least = LEAST_FAMILIAR - DEVIATIONS * F.sqrt(LEAST_FAMILIAR * (1 - LEAST_FAMILIAR) / F.greatest(F.col("n_grams"), F.lit(1)))
    good = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("familiar") >= least)
    return found.filter(good).select(*docs.columns)


@_carrying
def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least four fifths of its five-word shingles.

    The next stage takes what stands twice out of both copies, so none may be left here: rows without a doc_id, and
    further texts under one doc_id, take part as documents of their own, and of rows equal in id and text the least
    stays. Their ids are hashes of the text above all others, so a row with an id of its own is kept before them.
    """
    digest = F.struct(F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2"))
    # Only rows that share their id with others need more than it.
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"), F.min(digest).alias("_first"))
    again = written(again.filter("_n > 1").drop("_n"), "repeated-ids")
    named = docs.join(again, "doc_id", "left")
    own = F.col("doc_id").isNotNull() & (F.col("_first").isNull() | (F.col("_first") == digest))
    by_text = F.lit(_BY_TEXT) + digest["t1"].bitwiseAND(F.lit(_BY_TEXT - 1))
    named = named.withColumn("_id", F.when(own, F.col("doc_id").cast("long")).otherwise(by_text))
    dropped = minhash.near_duplicates(named.select(F.col("_id").alias("doc_id"), "text"), words=5, percent=80)
    dropped = written(dropped.filter("NOT kept").select(F.col("doc_id").alias("_id")).distinct(), "dropped")
    left = named.join(dropped, "_id", "left_anti")
    alone = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("_unnamed"), F.struct(*docs.columns).alias("row"))).alias("_least")
    repeated = left.filter(~alone).groupBy("_id").agg(least).select("_least.row.*")
    return left.filter(alone).select(*docs.columns).unionByName(repeated)


@_carrying
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 200 bytes that stand elsewhere too. What a cut leaves of a character goes. No row goes: a
    null text stays null, and a text that is all repeats becomes empty."""
    text = F.when(F.size("removed") > 0, F.try_validate_utf8(F.col("kept_bytes").cast("string"))).otherwise(F.col("_whole"))
    cut = suffix.remove_repeats(docs.withColumn("_whole", F.col("text")))
    mended = F.coalesce(text, F.replace(F.make_valid_utf8(F.col("kept_bytes").cast("string")), F.lit("�"), F.lit("")))
    out = cut.withColumn("text", F.when(F.col("_whole").isNotNull(), mended))
    return out.withColumn("n_chars", F.when(F.col("_whole").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in sequences of at most 2048 tokens. A null or empty text is its end id alone; rows
    that repeat an id are packed one by one."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, size=2048, with_ids=False)


STAGES = [
    ("language_id", identified),
    ("minhash_near_dedup", deduplicated),
    ("suffix_array_dedup", without_repeats),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The stages call tokenizers and learned models; tests/llm holds run() against brute force.
ORACLE_SQL = None
