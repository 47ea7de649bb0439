"""Resolves "not modified" revisits of web archives to the response they stand for.

A revisit record says that a page had not changed; it has headers and validators, and no body. It is resolved to the
latest earlier full response of the same canonical URL. Its entity tag (weak comparison) or, without one, its
Last-Modified date must agree with the response's. Then the revisit's permitted headers replace the response's.

The join is one window over both kinds of records by canonical URL and time. A URL with very many captures is cut into
slices of time; what the slices before one end with comes in as one row per slice.

Rules for odd input: a record without a URL or time resolves to nothing (``no_response``); of two responses at one time the one
with the greater id is the later; a response at the time of the revisit is earlier if its id is less; repeated rows are
records of their own; header names are compared in lower case, and the first of equal names counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import parts_for

ROWS_PER_SLICE = 100_000
#: The headers that a "304 Not Modified" answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Without scheme, user, default port, leading ``www``, ``m`` labels, fragment and tracking parameters; host in lower
    case, parameters in order, no slash at the end."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^(www[0-9]*|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    asked = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(r"^(?i:utm_[a-z]+|ref|sessionid|sid|phpsessid|jsessionid)(=|$)")))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of equal names the first counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda x: x["key"] == e["key"]))
    return F.coalesce(F.map_from_entries(first), F.expr("map_from_arrays(array(''), array(''))"))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers, with the permitted ones of the update in place of theirs."""
    new = F.map_filter(update, lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter(stored, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_filter(F.map_concat(old, new), lambda k, v: k != "")


def header_text(headers: Column) -> Column:
    """``name: value`` lines in order of the names."""
    lines = F.transform(F.array_sort(F.map_keys(headers)), lambda k: F.concat(k, F.lit(": "), F.coalesce(F.element_at(headers, k), F.lit(""))))
    return F.array_join(lines, "\n")


def resolve(records: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per revisit of ``records`` (record_id, url, time in seconds, kind ``response`` or ``revisit``, headers map,
    payload_digest, payload_length): its record_id, url_key, the response_id found, the outcome, the payload's digest
    and length, and the merged headers. Outcomes: ``resolved``, ``mismatch`` (a validator differs), ``unvalidated`` (the
    revisit has no validator or the response lacks it) and ``no_response``."""
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("url_key"), F.col("time").cast("long").alias("time"), "kind",
        lower_names(F.col("headers")).alias("headers"), "payload_digest", "payload_length",
    )
    usable = rows.filter(F.col("url_key").isNotNull() & F.col("time").isNotNull())
    response = F.when(F.col("kind") == "response", F.struct("time", "record_id", "headers", "payload_digest", "payload_length"))
    span = usable.groupBy("url_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most")).first()
    ends = usable.agg(F.min("time").alias("a"), F.max("time").alias("b")).first()
    slices = parts_for(span.most or 0, rows_per_slice)
    width = 1 if ends.a is None else max(1, -(-(ends.b - ends.a + 1) // slices))
    cut = usable.withColumn("_slice", F.floor((F.col("time") - F.lit(ends.a or 0)) / width)).withColumn("_response", response)
    window = Window.partitionBy("url_key", "_slice").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = cut.withColumn("_found", F.last("_response", ignorenulls=True).over(window))
    if slices > 1:
        last = cut.filter("_response IS NOT NULL").groupBy("url_key", "_slice").agg(F.max_by("_response", F.struct("time", "record_id")).alias("_last"))
        # A slice without a response needs its carry too: all slices in use, one row each.
        used = cut.select("url_key", "_slice").distinct().join(last, ["url_key", "_slice"], "left")
        earlier = Window.partitionBy("url_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = used.select("url_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
        found = found.join(carry, ["url_key", "_slice"], "left").withColumn("_found", F.coalesce("_found", "_carry")).drop("_carry")
    revisits = found.filter("kind = 'revisit'").select("record_id", "url_key", "headers", "_found")
    lost = rows.filter((F.col("kind") == "revisit") & (F.col("url_key").isNull() | F.col("time").isNull()))
    revisits = revisits.unionByName(lost.select("record_id", "url_key", "headers").withColumn("_found", F.lit(None).cast(revisits.schema["_found"].dataType)))

    tag = lambda h: F.regexp_replace(F.element_at(h, "etag"), r"^[Ww]/", "")
    own, stored = F.col("headers"), F.col("_found.headers")
    dated = lambda h: F.element_at(h, "last-modified")
    agrees = F.when(tag(own).isNotNull() & tag(stored).isNotNull(), tag(own) == tag(stored)).when(
        tag(own).isNull() & dated(own).isNotNull() & dated(stored).isNotNull(), dated(own) == dated(stored)
    )
    outcome = F.when(F.col("_found").isNull(), "no_response").when(agrees.isNull(), "unvalidated").when(agrees, "resolved").otherwise("mismatch")
    good = F.col("outcome") == "resolved"
    return revisits.withColumn("outcome", outcome).select(
        "record_id", "url_key", "outcome",
        F.when(good, F.col("_found.record_id")).alias("response_id"),
        F.when(good, F.col("_found.payload_digest")).alias("payload_digest"),
        F.when(good, F.col("_found.payload_length")).alias("payload_length"),
        F.when(good, merged_headers(stored, own)).otherwise(F.map_filter(own, lambda k, v: k != "")).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """An archive made of the pages: each is a full response at its number in minutes, and is revisited later through
    another spelling of its URL. Some revisits carry no tag, no validator at all, or a tag of another version."""
    number = F.col("page_id")
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (number % 28).cast("string"))
    base = pages.select(number, "url", digest.alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("size"), tag.alias("tag"), modified.alias("modified"))
    response = F.struct(
        (number * 2).alias("record_id"), F.col("url"), (number * 60).alias("time"), F.lit("response").alias("kind"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), F.col("tag"), F.lit("Last-Modified"), F.col("modified"),
            F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Server"), F.lit("origin"),
        ).alias("headers"),
        F.col("digest").alias("payload_digest"), F.col("size").alias("payload_length"),
    )
    wrong = F.when(number % 13 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), F.col("tag")))
    headers = F.map_filter(
        F.create_map(
            F.lit("etag"), F.when(number % 5 != 0, wrong), F.lit("last-modified"), F.when(number % 11 != 0, F.col("modified")),
            F.lit("cache-control"), F.concat(F.lit("max-age="), (number % 100).cast("string")), F.lit("server"), F.lit("cache"),
            F.lit("date"), F.concat(F.lit("minute "), number.cast("string")),
        ),
        lambda k, v: v.isNotNull(),
    )
    other = F.concat(F.regexp_replace("url", r"^https?://", "HTTP://WWW."), F.when(F.col("url").contains("?") | F.col("url").contains("#"), F.lit("")).otherwise(F.lit("?utm_source=revisit")))
    revisit = F.struct(
        (number * 2 + 1).alias("record_id"), other.alias("url"), (number * 60 + (number % 97) * 3600 + 30).alias("time"), F.lit("revisit").alias("kind"),
        headers.alias("headers"), F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("long").alias("payload_length"),
    )
    return base.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")
