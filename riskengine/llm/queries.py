"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm import bpe, langid, lbl, minhash, packing, ranked, simhash, suffix, tokenfile, trie, vptree, warc, whiten
from riskengine.session import shared_dir

REGISTRY: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path))


@query
def op5_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=0, size=2048, with_ids=False)


@query
def op8_token_files(spark, sf_dir):
    out = shared_dir(spark, "llm-token-files")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokenfile.read_tokens(spark, out, with_ids=False)


@query
def op9_vptree(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


ORACLES["op9_vptree"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op2_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_lbl(spark, sf_dir):
    return lbl.score_documents(table(spark, sf_dir, "documents"))


@query
def op3_suffix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.digests(suffix.remove_repeats(docs, length=200))


@query
def op6_simhash(spark, sf_dir):
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_revisits(spark, sf_dir):
    found = warc.resolve(warc.captures(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", warc.header_text(F.col("headers")))


@query
def op11_trie(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return trie.digests(trie.encode(docs, path), path)


@query
def op12_whiten(spark, sf_dir):
    return whiten.whiten(table(spark, sf_dir, "embeddings"), k=16)


@query
def op13_ranked(spark, sf_dir):
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


ORACLES["op13_ranked"] = r"""
WITH found AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
d AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM found WHERE len(terms) > 0),
whole AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM d),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
t AS (SELECT r, unnest(terms) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(N) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, whole GROUP BY term),
s AS (SELECT i.item_id, d.r, d.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * d.n * whole.N) // whole.L)))) AS BIGINT) AS score
      FROM i JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), whole GROUP BY i.item_id, d.r, d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


ORACLES["op7_revisits"] = r"""
WITH p AS (SELECT page_id, url, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size FROM pages),
r AS (SELECT page_id, url, digest, size, page_id * 60 AS t, 'W/"' || substr(digest, 1, 16) || '"' AS weak, 'day ' || page_id % 28 AS modified FROM p),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM r),
parts AS (SELECT *,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^(www[0-9]*|m)\.', '') AS host1,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
        lambda q: q <> '' AND NOT regexp_matches(q, '^(?i:utm_[a-z]+|ref|sessionid|sid|phpsessid|jsessionid)(=|$)'))) AS q FROM bare),
k AS (SELECT *, path || CASE WHEN len(q) > 0 THEN '?' || list_aggregate(q, 'string_agg', '&') ELSE '' END AS tail,
    regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), ':(80|443)$', '') AS host2 FROM parts),
responses AS (SELECT page_id, host1 || tail AS url_key, t, digest, size, modified, substr(weak, 3) AS tag FROM k),
revisits AS (SELECT page_id, host2 || tail AS url_key, t + page_id % 97 * 3600 + 30 AS t,
    CASE WHEN page_id % 5 <> 0 THEN CASE WHEN page_id % 13 = 0 THEN '"other"' ELSE weak END END AS tag,
    CASE WHEN page_id % 11 <> 0 THEN modified END AS modified FROM k),
ranked AS (SELECT v.page_id, v.url_key, v.tag, v.modified, s.page_id AS found, s.digest, s.size, s.tag AS stag, s.modified AS smod,
    row_number() OVER (PARTITION BY v.page_id ORDER BY s.t DESC, s.page_id DESC) AS n
  FROM revisits v LEFT JOIN responses s ON s.url_key = v.url_key AND (s.t < v.t OR (s.t = v.t AND s.page_id * 2 < v.page_id * 2 + 1))),
judged AS (SELECT *, CASE WHEN found IS NULL THEN 'no_response'
    WHEN tag IS NOT NULL THEN CASE WHEN replace(tag, 'W/', '') = stag THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL THEN CASE WHEN modified = smod THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unvalidated' END AS outcome FROM ranked WHERE n = 1)
SELECT page_id * 2 + 1 AS record_id, url_key, outcome,
    CASE WHEN outcome = 'resolved' THEN found * 2 END AS response_id,
    CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest,
    CASE WHEN outcome = 'resolved' THEN size END AS payload_length,
    CASE WHEN outcome = 'resolved'
      THEN 'cache-control: max-age=' || page_id % 100 || chr(10) || 'content-type: text/html' || chr(10) || 'date: minute ' || page_id || chr(10) ||
           'etag: ' || coalesce(tag, stag) || chr(10) || 'last-modified: ' || smod || chr(10) || 'server: origin'
      ELSE 'cache-control: max-age=' || page_id % 100 || chr(10) || 'date: minute ' || page_id || coalesce(chr(10) || 'etag: ' || tag, '') ||
           coalesce(chr(10) || 'last-modified: ' || modified, '') || chr(10) || 'server: cache' END AS headers
FROM judged
"""
