import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskengine import schemas
from riskengine.sources.sinks import write_batch, write_parts
from riskengine.streaming import compact, jobs

DAY = datetime(2026, 1, 1)


def write(spark, table, batch_id, n=6, change=0):
    """A batch with a hot account, two days, and a row without an account."""
    rows = []
    for i in range(n):
        time = DAY + timedelta(days=(batch_id + i) % 2, seconds=batch_id)
        time = None if batch_id == 1 and i == 5 else time  # a row without a time, and so without a day
        account = None if i == 0 else "HOT" if i < 4 else f"A{i}"
        rows.append((f"{batch_id}-{i}", account, change + i, time, time and time.date()))
    df = spark.createDataFrame(rows, "transaction_id string, account_id string, amount long, event_time timestamp, event_date date")
    for f in schemas.DECIDED_LOG.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    write_parts(df.coalesce(1).withColumn("batch_id", F.lit(batch_id)), f"{table.path}/log", "event_date", "batch_id")
    homes = df.groupBy("account_id").agg(F.lit(f"home{batch_id}").alias("home")).coalesce(1)
    write_batch(homes, f"{table.path}/homes", batch_id)


def content(df):
    return sorted(map(str, df.select("transaction_id", "account_id", "amount", "event_time", "event_date", "batch_id").collect()))


def test_many_batches_become_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compact, "BUCKETS", 4)
    monkeypatch.setattr(compact, "ROWS_PER_FILE", 100)
    log, plain = jobs.DecisionLog(str(tmp_path / "a")), jobs.DecisionLog(str(tmp_path / "b"))
    assert content(log.rows.read(spark)) == []
    for batch in range(40):
        write(spark, log, batch)
    shutil.copytree(log.path, plain.path)
    before = content(plain.rows.read(spark))
    assert len(before) == 240
    log.compact(spark, 25)
    log.compact(spark, 25)
    assert content(log.rows.read(spark)) == before
    # The last batch is run again with other rows, after it was written and before the next merge.
    write(spark, log, 39, change=10)
    write(spark, plain, 39, change=10)
    log.compact(spark, 38)
    again = content(plain.rows.read(spark))
    assert again != before and content(log.rows.read(spark)) == again
    # Per day: a bucket each, one more for each 100 rows, and the folders of the one batch that is not merged.
    assert len(log.rows.read(spark, 39).inputFiles()) <= 2 * (4 + 2 + 1) < len(plain.rows.read(spark, 39).inputFiles())
    one_day = [str(DAY.date())]
    assert content(log.rows.read(spark, 37, one_day)) == content(plain.rows.read(spark, 37, one_day))
    homes = {r.account_id: r.home for r in log.homes.read(spark).groupBy("account_id").agg(F.min_by("home", "batch_id").alias("home")).collect()}
    assert homes == {a: "home0" for a in (None, "HOT", "A4", "A5")}
    assert log.homes.read(spark).filter("batch_id < 39").count() == 4


def test_a_version_without_its_manifest_is_not_seen(spark, tmp_path):
    log = jobs.DecisionLog(str(tmp_path))
    for batch in range(4):
        write(spark, log, batch)
    before = content(log.rows.read(spark))
    log.rows.compact(spark, 1)
    # A merge that stopped before it wrote its manifest.
    write_parts(spark.read.parquet(f"{tmp_path}/log").limit(3).withColumn("bucket", F.lit(0)), f"{tmp_path}/merged-log/version=2", "event_date", "bucket")
    assert content(log.rows.read(spark)) == before
    log.rows.compact(spark, 2)
    assert content(log.rows.read(spark)) == before


@pytest.mark.parametrize("upto", [0, 2])
def test_rule_table(spark, tmp_path, upto):
    path = str(tmp_path / "rules")
    assert jobs.read_rule_table(spark, path).count() == 0
    for batch in range(3):
        rows = [(f"R{batch}", "amount", "GT", batch, None, "BLOCK", True, batch, None)]
        write_batch(spark.createDataFrame(rows, schemas.RULE_UPDATE), path, batch)
    before = sorted(map(str, jobs.read_rule_table(spark, path).collect()))
    jobs.compact_rule_table(spark, path, upto)
    assert sorted(map(str, jobs.read_rule_table(spark, path).collect())) == before and len(before) == 3
