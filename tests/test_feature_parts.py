"""The windows' exchange gets more partitions as the input grows, so that one task's share stays bounded."""

import datetime as dt

from riskengine.operators import features


def test_partitions_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(features, "ROWS_PER_TASK", 10, raising=False)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (str(i), f"ACC_{i % 7:05d}", 100 * i, start + dt.timedelta(minutes=i), i % 2 == 0, True, False)
        for i in range(100)
    ]
    df = spark.createDataFrame(
        rows, "transaction_id string, account_id string, amount long, event_time timestamp, is_home boolean, "
        "is_domestic boolean, is_fraud boolean",
    )
    plan = features.training_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and ", 10)" in plan.split("hashpartitioning(account_id")[1].split("\n")[0], plan
