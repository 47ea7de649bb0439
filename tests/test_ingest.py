import json

import pytest

from riskengine import schemas
from riskengine.sources import parsing, readers, sinks

GOOD = {
    "transaction_id": "6f1c1a9e-0a3b-4c5d-8e7f-0123456789ab",
    "produced_at": "2026-01-01T00:00:00.123456Z",
    "event_time": "2026-01-01T07:00:00+07:00",
    "account_id": "ACC_00001",
    "card_id": "CARD_00001",
    "amount": 1.9,
    "channel": "ATM",
    "location_name": "Hanoi",
    "status": "Approved",
}
RULE = {"rule_id": "R1", "field": "amount", "operator": "GT", "action": "BLOCK", "enabled": True}


def without(doc, key):
    return {k: v for k, v in doc.items() if k != key}


def raw(spark, *docs):
    rows = [(d if isinstance(d, str) else json.dumps(d), "transactions", 3, i) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def test_good_transaction(spark):
    r = parsing.parse_transactions(raw(spark, GOOD)).selectExpr("*", "unix_micros(event_time) AS us").first()
    assert r.errors == [] and r.amount == 1 and r.us == 1767225600000000
    assert r.account_id == "ACC_00001"


BAD = [
    ("nope", ["not valid JSON"]),
    ("", ["not valid JSON"]),
    ("[1]", ["must be an object"]),
    ({**GOOD, "is_fraud": True}, ["is_fraud: not allowed"]),
    ({**GOOD, "location_name": 5}, ["location_name: must be of type string"]),
    (json.dumps(GOOD)[:-1], ["not valid JSON"]),
    (without(GOOD, "card_id"), ["card_id: required but missing"]),
    ({**GOOD, "account_id": "ACC_1"}, ["account_id: must match ^(ACC_[0-9]{5}|FRD_[A-Z0-9_]+)$"]),
    ({**GOOD, "card_id": "CARD_1"}, ["card_id: must match ^(CARD|FRD_CARD)_[0-9]{5}$"]),
    ({**GOOD, "channel": "WEB"}, ["channel: must be one of ATM, POS, ONLINE"]),
    ({**GOOD, "status": "approved"}, ["status: must be one of Approved, Declined"]),
    ({**GOOD, "amount": "5"}, ["amount: must be of type number"]),
    ({**GOOD, "amount": 1e30}, ["amount: out of range"]),
    ({**GOOD, "location_name": None}, ["location_name: must be of type string"]),
    ({**GOOD, "transaction_id": "x"}, ["transaction_id: must be a uuid"]),
    ({**GOOD, "event_time": "2026-13-01T00:00:00Z"}, ["event_time: must be a date-time"]),
    ({**GOOD, "event_time": "2026-01-01T00:00:00"}, ["event_time: must be a date-time"]),
    ({**GOOD, "channel": 1, "status": "x"}, ["channel: must be one of ATM, POS, ONLINE", "status: must be one of Approved, Declined"]),
]


def test_bad_transactions(spark):
    got = parsing.parse_transactions(raw(spark, *[d for d, _ in BAD])).orderBy("offset").collect()
    assert [r.errors for r in got] == [e for _, e in BAD]
    assert all(r.account_id is None for r in got)


@pytest.mark.parametrize("change,expected", [
    ({}, []),
    ({"threshold": 5, "value": "x"}, []),
    ({"threshold": 5.0}, []),
    ({"threshold": 5.5}, ["threshold: must be of type integer"]),
    ({"field": "channel"}, ["field: must be one of amount, account_id"]),
    ({"operator": "IN"}, ["operator: must be one of GT, GTE, LT, LTE, EQ, NEQ"]),
    ({"action": "LOG"}, ["action: must be one of BLOCK, ALERT"]),
    ({"enabled": "true"}, ["enabled: must be of type boolean"]),
    ({"note": 1}, ["note: not allowed"]),
])
def test_rules(spark, change, expected):
    r = parsing.parse_rules(raw(spark, {**RULE, **change})).first()
    assert r.errors == expected
    if not expected:
        assert r.threshold == int(change.get("threshold", 0)) and r.value == change.get("value") and r.enabled


HUGE = ["9223372036854775808", "-9223372036854775809", "1e40", "-1e40", "1e400", "9" * 36, "1" + "0" * 37]


@pytest.mark.parametrize("number", HUGE)
def test_numbers_out_of_range_are_dead_letters(spark, number):
    tx = json.dumps(GOOD).replace(f'"amount": {json.dumps(GOOD["amount"])}', f'"amount": {number}')
    rule = json.dumps({**RULE, "threshold": 1}).replace('"threshold": 1', f'"threshold": {number}')
    for parsed, field in ((parsing.parse_transactions(raw(spark, tx)), "amount"), (parsing.parse_rules(raw(spark, rule)), "threshold")):
        r = parsed.first()
        assert [e.split(":")[0] for e in r.errors] == [field] and r[field] is None


@pytest.mark.parametrize("number,value", [("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -(2**63)), ("1.9", 1), ("-1.9", -1), ("1e-20", 0)])
def test_numbers_in_range(spark, number, value):
    tx = json.dumps(GOOD).replace(f'"amount": {json.dumps(GOOD["amount"])}', f'"amount": {number}')
    r = parsing.parse_transactions(raw(spark, tx)).first()
    assert r.errors == [] and r.amount == value


def test_sources_share_a_dead_letter_path(spark, tmp_path):
    _, bad = parsing.split_dlq(parsing.parse_transactions(raw(spark, "nope")))
    for source in ("transactions", "rules-updates"):
        for batch in (0, 1):
            sinks.write_dlq(parsing.dlq_records(bad), str(tmp_path), source, batch)
    assert spark.read.text(str(tmp_path)).count() == 4


def test_split_and_dlq_round_trip(spark, tmp_path):
    good, bad = parsing.split_dlq(parsing.parse_transactions(raw(spark, GOOD, "nope", {**GOOD, "x": 1})))
    assert good.count() == 1
    sinks.write_dlq(parsing.dlq_records(bad), str(tmp_path / "dlq"), "transactions", 7)
    sinks.write_dlq(parsing.dlq_records(bad), str(tmp_path / "dlq"), "transactions", 7)  # a retry
    out = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "dlq")).collect()), key=lambda d: d["offset"])
    assert [list(d) for d in out] == [["sourceTopic", "partition", "offset", "rawPayload", "errorMessage", "failedAt"]] * 2
    assert (out[0]["rawPayload"], out[0]["partition"], out[0]["offset"]) == ("nope", 3, 1)


def test_text_and_parquet_messages(spark, tmp_path):
    raw(spark, GOOD).select("value").write.text(str(tmp_path / "text"))
    raw(spark, GOOD).write.parquet(str(tmp_path / "pq"))
    for fmt, sub in (("text", "text"), ("parquet", "pq")):
        df = readers.read_transactions(spark, fmt, str(tmp_path / sub), streaming=False)
        assert parsing.parse_transactions(df).first().errors == []
    assert readers.kafka_options("h:1", "t")["startingOffsets"] == "earliest"


def test_tables(spark, tmp_path):
    (tmp_path / "accounts.csv").write_text("account_id,card_id,home_location,avg_amount\nACC_00001,CARD_00001,Hanoi,500000\n")
    assert readers.read_accounts(spark, str(tmp_path / "accounts.csv")).first().avg_amount == 500000
    (tmp_path / "data.csv").write_text(
        "account_id,amount,event_time,is_home,is_domestic,is_fraud\nA,5,2026-06-25T01:02:03+00:00,True,False,True\n"
    )
    r = readers.read_labelled(spark, str(tmp_path / "data.csv")).selectExpr("*", "hour(event_time) AS h").first()
    assert (r.h, r.is_home, r.is_domestic, r.is_fraud) == (1, True, False, True)
    (tmp_path / "levels.json").write_text('[{"tps": 500, "start": "2026-07-05T13:27:12.901645+00:00", "end": "2026-07-05T13:28:12+00:00"}]')
    assert readers.read_load_levels(spark, str(tmp_path / "levels.json")).first().tps == 500


def test_ground_truth_append_reset_and_labels(spark, tmp_path):
    path = str(tmp_path / "truth")
    df = parsing.split_dlq(parsing.parse_transactions(raw(spark, GOOD)))[0].selectExpr("*", "true AS is_fraud", "'X' AS fraud_pattern")
    sinks.write_ground_truth(df, path)
    sinks.write_ground_truth(df, path)
    assert spark.read.parquet(path).count() == 2
    assert "is_fraud" not in sinks.drop_labels(df).columns
    sinks.reset_table(spark, path, schemas.GROUND_TRUTH)
    assert spark.read.parquet(path).count() == 0


def test_report_is_sorted(spark, tmp_path):
    sinks.write_report(spark.range(10).selectExpr("10 - id AS v"), str(tmp_path / "r"), "v")
    parts = sorted((tmp_path / "r").glob("*.csv"))
    lines = [int(x) for p in parts for x in p.read_text().splitlines()[1:]]
    assert lines == sorted(lines) and len(lines) == 10
