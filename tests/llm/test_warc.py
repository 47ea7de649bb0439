import pytest
from check import compare

from __spark_entry__ import oracle_sql  # noqa: F401
from riskengine.llm import warc

SCHEMA = "record_id long, url string, time long, kind string, headers map<string,string>, payload_digest string, payload_length long, url_key string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def response(i, url, t, **h):
    return (i, url, t, "response", {k.replace("_", "-"): v for k, v in h.items()}, f"d{i}", i)


def revisit(i, url, t, **h):
    return (i, url, t, "revisit", {k.replace("_", "-"): v for k, v in h.items()}, None, None)


@pytest.mark.parametrize("per_slice", [1, 3, 10**6])
def test_resolution(spark, per_slice):
    a = "http://www.Site.org:80/x/?b=2&utm_source=q&a=1#top"
    rows = [
        response(1, "https://site.org/x?a=1&b=2", 10, ETag='"v1"', Server="o", Vary="x"),
        response(2, a, 20, ETag='W/"v2"', Cache_Control="old", Last_Modified="m"),
        revisit(3, a, 15, etag='"v1"', server="cache", cache_control="new"),
        revisit(4, a, 25, etag='"v2"', expires="e"),
        revisit(5, a, 26, etag='"v1"'),
        revisit(6, a, 27, last_modified="m"),
        revisit(7, a, 27, last_modified="n"),
        revisit(8, a, 27),
        revisit(9, a, 9, etag='"v1"'),
        revisit(10, None, 30, etag='"v1"'),
        revisit(11, a, None, etag='"v1"'),
        response(12, a, 40),
        revisit(13, a, 40, etag='"v2"'),
        response(14, a, 40, ETag='"v3"'),
        revisit(15, a, 40, etag='"v3"'),
        (16, "", 50, "revisit", None, None, None),
        revisit(17, a, 9_000, etag='"v3"'),
        revisit(17, a, 9_000, etag='"v3"'),
    ]
    got = warc.resolve(made(spark, rows), per_slice).collect()
    by = {r.record_id: r for r in got}
    assert len(got) == 14 and sum(r.record_id == 17 for r in got) == 2
    assert {k: (r.outcome, r.response_id) for k, r in by.items()} == {
        3: ("resolved", 1), 4: ("resolved", 2), 5: ("mismatch", None), 6: ("resolved", 2), 7: ("mismatch", None), 8: ("unvalidated", None),
        9: ("no_response", None), 10: ("no_response", None), 11: ("no_response", None), 13: ("unvalidated", None), 15: ("resolved", 14),
        16: ("no_response", None), 17: ("resolved", 14),
    }
    assert by[3].headers == {"etag": '"v1"', "server": "o", "vary": "x", "cache-control": "new"}
    assert by[4].headers == {"etag": '"v2"', "cache-control": "old", "last-modified": "m", "expires": "e"}
    assert (by[4].payload_digest, by[4].payload_length, by[5].payload_digest) == ("d2", 2, None)
    assert by[3].url_key == "site.org/x?a=1&b=2"


def test_one_busy_url(spark):
    rows = [response(2 * i, "http://a.org/", i * 7 % 101, ETag=f'"{i}"') for i in range(300)]
    rows += [revisit(2 * i + 1, "http://a.org", i * 11 % 103, etag=f'"{i}"') for i in range(300)]
    pick = lambda n: {r.record_id: (r.outcome, r.response_id) for r in warc.resolve(made(spark, rows), n).collect()}
    assert pick(10) == pick(10**6)


def test_empty_and_query(spark, sf_dir):
    assert warc.resolve(made(spark, [])).count() == 0
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    ok, note = compare(spark, con, "op7_revisits", sf_dir)
    assert ok, note
