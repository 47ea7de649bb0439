"""What the plans must look like for large inputs."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from test_cep import frame, same

from riskengine import schemas
from riskengine import testviews as V
from riskengine.operators import features, rules
from riskengine.operators.rules import active_rules
from riskengine.plans import decide as D
from riskengine.plans import profile, reports
from riskengine.sources import sinks


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_time_range_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    df = frame(spark, same(5, "Approved", [0, 1, 2])).withColumn("produced_at", F.col("event_time")).withColumn("decided_at", F.col("event_time"))
    df = df.withColumns({"rule_hit": F.lit("R"), "cep_pattern": F.lit(None).cast("string"), "ml_score": F.lit(0.5), "decision": F.lit("ALERT")})
    sinks.write_decisions(df, path, 1)
    sinks.write_decisions(df, path, 1)
    sinks.write_alerts(df, str(tmp_path / "a"), 1)
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(str(tmp_path / "a")).count() == 3
    sinks.write_decisions(df.withColumn("transaction_id", F.concat(F.lit("n"), "transaction_id")), path, 2)
    assert sinks.read_decisions(spark, path).count() == 6
    assert sinks.read_decisions(spark, path).columns[:3] == ["transaction_id", "account_id", "amount"]
    stored = spark.read.parquet(path)
    text = plan(reports.avg_latency(reports.report_rows(stored, start=datetime(2026, 1, 1, tzinfo=timezone.utc))))
    assert "GreaterThanOrEqual(produced_at" in text
    assert "ReadSchema: struct<account_id:string,produced_at:timestamp,decided_at:timestamp>" in text
    by_day = plan(stored.filter("decided_date = DATE'2026-01-01'"))
    assert "PartitionFilters: [isnotnull(decided_date" in by_day


def test_decide_shuffles_once(spark, sf_dir):
    df = D.decide(V.transactions(spark, sf_dir), active_rules(V.rule_updates(spark, sf_dir)))
    text = initial(df)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 and "Join" not in text


def test_reports_have_no_python_and_no_cross_join(spark, sf_dir):
    labelled = reports.with_truth(V.decisions(spark, sf_dir), V.ground_truth(spark, sf_dir))
    one, many = 1_000_000, 100
    for df in (
        reports.auc_roc(labelled), reports.auc_roc(labelled, rows_per_bucket=many), reports.auc_pr(labelled, ties="row"),
        reports.latency_percentiles(V.decisions(spark, sf_dir), one), reports.latency_percentiles(V.decisions(spark, sf_dir), many),
        reports.latency_by_level(V.decisions(spark, sf_dir), V.load_levels(spark, sf_dir)),
        profile.profile(V.labelled(spark, sf_dir)), rules.apply_rules_asof(V.transactions(spark, sf_dir), V.rule_updates(spark, sf_dir)),
        features.serving_features(V.transactions(spark, sf_dir), F.lit(True)),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_decision_columns(spark, sf_dir):
    out = D.to_decision(D.decide(V.transactions(spark, sf_dir), spark.createDataFrame([], schemas.RULE)))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.DECISION]
