"""Small tables with odd rows, for all operators of the folder."""

import duckdb
import pyarrow.parquet as pq

ODD = [
    (1000, None, "en", "s", 0),
    (1001, "", "en", "s", 0),
    (1002, " \n\t ", None, "s", 0),
    (None, "a row without an id, twice", "en", "s", 0),
    (None, "a row without an id, twice", "en", "s", 0),
    (1003, "the same row twice " * 20, "en", None, 0),
    (1003, "the same row twice " * 20, "en", None, 0),
    (1004, "Ünï çødé 日本語 テキスト  two  spaces\r\n\tand tabs it's", "de", "s", 0),
    (1005, "x" * 30_000, None, "s", 0),
    (1006, "very long words and lines " * 8_000, "en", "s", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf_dir, n=None):
    rows = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    return rows[:n] if n else rows


def sql(sf_dir, text, tables):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(text).fetchall()
