import random

import corpus_pipeline
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import util
from .test_minhash import brute as near_groups
from .test_packing import check, wanted
from .test_suffix import brute as repeats


def without_repeats(texts, length=200):
    from collections import Counter

    data = [t.encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore"))
    assert [len(d) for d in data] == [r[0] for r in repeats(texts, length)]
    return out


def test_run_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in util.documents(sf_dir)]
    # The data's documents are all in a known language: none is rejected.
    kept = {d for d, _, _, k in near_groups(rows, 5, 80) if k}
    rows = [r for r in rows if r[0] in kept]
    rows = list(zip([d for d, _ in rows], without_repeats([t for _, t in rows])))
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = wanted(rows, tokenizer, 0, 2048)
    used = check(corpus_pipeline.run(spark, sf_dir).collect(), want, 2048)
    assert used <= -(-sum(p[3] for p in want.elements()) // 2048) + 1


FOREIGN = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita. " * 2,
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki",
    "<div class='nav'><ul><li><a href='x.html'>home</a></li></ul></div> <script>var a = function(){return b}</script>",
    "xq zkv wpt jjx qqrz vbnm ktrw xxz plk mnbv ghjk zzq wrt",
    "всеобщая декларация прав человека принята и провозглашена резолюцией ассамблеи",
    "12 — 34",
]


def test_other_languages_and_junk_are_rejected_and_clean_texts_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)], util.SCHEMA)
    out = corpus_pipeline.identified(spark, docs.unionByName(more), "")
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r["doc_id"] for r in util.documents(sf_dir))


def test_columns_of_any_name_come_back_as_they_were(spark):
    names = ["score", "lang_pred", "held_out", "kept_bytes", "removed", "familiar", "n_grams", "_id", "_n", "_first", "_whole", "_text", "_k1", "a.b", "Found"]
    docs = util.odd(spark)
    for i, n in enumerate(names):
        docs = docs.withColumn(n, F.concat(F.lit(f"{i} "), F.coalesce(F.col("source"), F.lit("-"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert (out.columns, out.dtypes) == (docs.columns, docs.dtypes), name
        for r in out.collect():
            row = r.asDict()
            assert [row[n] for n in names] == [f"{i} {r.source or '-'}" for i in range(len(names))], name
    assert corpus_pipeline.packed(spark, docs, "").count() >= len(util.ODD)


def test_stages_on_odd_rows(spark):
    docs = util.odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert stage(spark, util.empty(spark), "").count() == 0, name
    letters = corpus_pipeline.identified(spark, docs, "").collect()
    assert {r.doc_id for r in letters} == {None, 1003, 1004, 1005, 1006}
    whole = corpus_pipeline.without_repeats(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in whole}[1000] is None
    assert {r.doc_id: r.text for r in whole}[1003] == ""
    assert corpus_pipeline.packed(spark, docs, "").count() >= len(util.ODD)


def test_one_of_each_repeated_row_survives(spark):
    rnd = random.Random(5)
    text = lambda n=80: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    twice, unnamed, both, first, second, other, plain = (text() for _ in range(7))
    near = first.rsplit(" ", 1)[0] + " changed"
    rows = [(20, twice, "en", "b", 1), (20, twice, "en", "a", 1), (20, twice, "en", "a", 1)]
    rows += [(None, unnamed, "en", "s", 1)] * 3 + [(None, unnamed, None, None, None)]
    rows += [(30, both, "en", "s", 1), (None, both, "en", "s", 1)]
    # One id with three texts: two near copies of each other, and one that stands under a smaller id too.
    rows += [(40, first, "en", "s", 1), (40, near, "en", "s", 1), (40, second, "en", "s", 1), (10, second, "en", "s", 1)]
    rows += [(None, other, "en", "s", 1), (None, other.rsplit(" ", 1)[0] + " changed", "en", "s", 1)]
    rows += [(50, plain, "en", "s", 1), (60, None, "en", "s", 1), (None, None, "en", "s", 1), (70, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, util.SCHEMA).repartition(5)
    out = corpus_pipeline.deduplicated(spark, docs, "")
    assert out.columns == docs.columns
    out = out.collect()
    texts = [r.text for r in out]
    for one in (twice, unnamed, both, second, plain, "", first[:400], other[:400]):
        assert len([t for t in texts if t is not None and (t.startswith(one) if one else t == "")]) == 1
    assert len(out) == 10
    assert [tuple(r) for r in out if r.text == twice] == [(20, twice, "en", "a", 1)]
    assert [r.doc_id for r in out if r.text == both] == [30]
    left = corpus_pipeline.without_repeats(spark, spark.createDataFrame(out, util.SCHEMA), "").collect()
    assert sorted(str(r.text) for r in left) == sorted(str(t) for t in texts)
