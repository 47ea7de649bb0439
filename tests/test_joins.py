from pyspark.sql import functions as F

from riskengine.operators.joins import salted_join
from riskengine.operators.steps import find_step


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_salted_side_is_shuffled_not_broadcast(spark, tmp_path):
    """The keyed side of a salted join is small in its files but repeated in every place: Spark must not broadcast it."""
    spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "keyed"))
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    big = spark.range(200).select((F.col("id") % 60).alias("k"), F.col("id").alias("t"))
    out = salted_join(big, keyed, "k", "left", "t")
    assert "BroadcastHashJoin" not in _plan(out)
    rows = {(r.t, r.v) for r in out.collect()}
    assert rows == {(t, 2 * (t % 60) if t % 60 < 50 else None) for t in range(200)}


def test_spread_steps_are_shuffled_not_broadcast(spark, tmp_path, monkeypatch):
    """Steps too many to broadcast are spread by key, not broadcast by Spark after all."""
    from riskengine.operators import steps as S

    monkeypatch.setattr(S, "fits_broadcast", lambda df, *a, **k: False)
    spark.range(40).select((F.col("id") % 4).alias("k"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 10).alias("hi"),
                           F.col("id").alias("hit")).write.parquet(str(tmp_path / "steps"))
    steps = spark.read.parquet(str(tmp_path / "steps"))
    points = spark.range(100).select(F.col("id").alias("t"), (F.col("id") % 4).alias("k"), (F.col("id") * 4).alias("at"))
    out = find_step(points, steps, "at", ["hit"], "t", ["k"])
    assert "BroadcastHashJoin" not in _plan(out)
    got = {(r.t, r.hit) for r in out.collect()}
    want = {(t, (t * 4) // 10 if t * 4 < 400 and ((t * 4) // 10) % 4 == t % 4 else None) for t in range(100)}
    assert got == want
