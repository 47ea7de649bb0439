"""The registered queries as plain SQL for a second engine, written the direct way: self-joins and frames instead of
carried state, so that agreement means something."""

from __future__ import annotations

from riskengine.constants import (
    ACCOUNT_ID_PATTERN, CARD_ID_PATTERN, DOMESTIC_LOCATIONS, RULE_TEST_ACCOUNTS_LIKE,
)
from riskengine.testviews import BASE_US, FOREIGN, SPAN_US


def _names(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_IN = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"

TX = f"""base AS (
  SELECT *, {BASE_US} + (epoch_us(ts) - {BASE_US}) // 24 AS e_us FROM events
), tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_id AS id, user_id,
    make_timestamp(e_us) AS produced_at, make_timestamp(e_us) AS event_time, e_us AS us, e_us // 1000 AS ms,
    concat('ACC_', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS account_id,
    concat('CARD_', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS card_id,
    CASE WHEN event_id % 97 = 0 THEN 1000000001 + event_id WHEN event_id % 10 < 4 THEN 2000 + event_id % 8001
      ELSE CAST(round(value * 100) AS BIGINT) * 20000 END AS amount,
    CASE WHEN event_id % 20 < 5 THEN 'ATM' WHEN event_id % 20 = 5 THEN 'POS' ELSE 'ONLINE' END AS channel,
    CASE WHEN event_id % 19 = 0 THEN ({_names(FOREIGN)})[CAST((event_id // 19) % 6 AS INTEGER) + 1]
      ELSE ({_names(DOMESTIC_LOCATIONS)})[CAST(user_id % 5 AS INTEGER) + 1] END AS location_name,
    CASE WHEN event_type IN ('error', 'signup') THEN 'Declined' ELSE 'Approved' END AS status,
    e_us + (event_id * 37 % 900) * 1000 AS decided_us,
    make_timestamp(e_us + (event_id * 37 % 900) * 1000) AS decided_at,
    (event_id * 7919 % 10000) / 10000.0e0 AS ml_score,
    ((event_id * 7919 % 10000) > 9300) <> (event_id % 50 = 0) AS is_fraud,
    concat('PATTERN_', upper(event_type)) AS fraud_pattern
  FROM base
)"""

DEC = """dec AS (
  SELECT transaction_id, account_id, amount, us, decided_us, produced_at, decided_at, is_fraud, fraud_pattern,
    decided_us // 1000 - us // 1000 AS latency_ms,
    CASE WHEN amount > 1000000000 THEN 'AMOUNT_THRESHOLD' END AS rule_hit,
    CASE WHEN amount > 1000000000 THEN NULL WHEN location_name IN ('Dunfallow', 'Eastmere', 'Farholm') THEN 'LOCATION_JUMP'
      WHEN status = 'Declined' AND channel = 'POS' THEN 'DECLINED_BURST' END AS cep_pattern,
    CASE WHEN amount > 1000000000 OR location_name IN ('Dunfallow', 'Eastmere', 'Farholm')
      OR (status = 'Declined' AND channel = 'POS') THEN NULL ELSE ml_score END AS ml_score,
    CASE WHEN amount > 1000000000 OR location_name IN ('Dunfallow', 'Eastmere', 'Farholm') THEN 'BLOCK'
      WHEN status = 'Declined' AND channel = 'POS' THEN 'ALERT'
      WHEN ml_score >= 0.9184e0 THEN 'ALERT' ELSE 'APPROVED' END AS decision
  FROM tx
)"""

LOG = f"""log AS (
  SELECT * FROM dec WHERE account_id NOT LIKE '{RULE_TEST_ACCOUNTS_LIKE}' AND account_id <> 'ACC_00001'
)"""

WINDOW = f"""account_id NOT LIKE '{RULE_TEST_ACCOUNTS_LIKE}' AND us >= {BASE_US} + 6 * 3600000000 AND us < {BASE_US} + 20 * 3600000000"""

MANY_UPDATES = f"""named AS (
  SELECT concat('C', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS rule_id, 'account_id' AS field,
    CASE WHEN c_custkey % 97 = 0 THEN 'NEQ' ELSE 'EQ' END AS operator, CAST(NULL AS BIGINT) AS threshold,
    concat('ACC_', lpad(CAST(c_custkey * 31 % 150 AS VARCHAR), 5, '0')) AS value, c_custkey AS k FROM customer
  UNION ALL
  SELECT concat('B', lpad(CAST(s_suppkey * 7919 % 100003 AS VARCHAR), 9, '0')), 'amount',
    (['GT', 'GTE', 'LT', 'LTE', 'EQ', 'NEQ'])[CAST(CASE WHEN s_suppkey % 41 = 0 THEN 5 ELSE s_suppkey % 5 END AS INTEGER) + 1],
    CASE WHEN s_suppkey % 5 < 2 THEN 1000000000 - s_suppkey * 9000 WHEN s_suppkey % 5 < 4 THEN 2000 + s_suppkey % 300
      ELSE 2000 + s_suppkey * 13 % 8001 END, NULL, s_suppkey + 500 FROM supplier
), timed AS (SELECT *, k * 7919 % 86400 * {SPAN_US // 86_400} AS at_us FROM named), upd AS (
  SELECT rule_id, field, operator, threshold, value, CASE WHEN k % 4 = 0 THEN 'ALERT' ELSE 'BLOCK' END AS action, true AS enabled,
    k * 2 AS seq, {BASE_US} + at_us AS updated_us FROM timed
  UNION ALL
  SELECT rule_id, field, operator, threshold, value, CASE WHEN k % 4 = 0 THEN 'ALERT' ELSE 'BLOCK' END, false,
    k * 2 + 1, {BASE_US} + at_us + (k % 50 + 1) * 60000000 FROM timed WHERE k % 3 <> 0 OR operator = 'NEQ'
)"""
UPDATES = f"""upd0 AS (SELECT *, (s_suppkey * 7919 + 41) % 100003 AS pos FROM supplier), upd AS (
  SELECT concat('RULE_', lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS rule_id,
    CASE WHEN s_nationkey % 5 < 3 THEN 'account_id' ELSE 'amount' END AS field,
    CASE WHEN s_nationkey % 5 < 3 THEN 'EQ' ELSE (['GT', 'GTE', 'LT', 'LTE', 'EQ'])[CAST(s_nationkey // 5 AS INTEGER) + 1] END AS operator,
    CASE WHEN s_nationkey % 5 < 3 THEN NULL WHEN s_nationkey // 5 < 2 THEN 1000000000 + s_suppkey * 10
      ELSE 2000 + s_suppkey % 50 END AS threshold,
    CASE WHEN s_nationkey % 5 < 3 THEN concat('ACC_', lpad(CAST(s_suppkey * 13 % 150 AS VARCHAR), 5, '0')) END AS value,
    CASE WHEN s_suppkey % 3 = 0 THEN 'ALERT' ELSE 'BLOCK' END AS action,
    s_suppkey % 4 <> 0 AS enabled, pos * 1000000 + s_suppkey AS seq, {BASE_US} + pos * {SPAN_US // 100_003} AS updated_us
  FROM upd0
), active AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY seq DESC) AS rn FROM upd)
  WHERE rn = 1 AND enabled
)"""

MATCH = """CASE field WHEN 'amount' THEN CASE operator
    WHEN 'GT' THEN amount > coalesce(threshold, 0) WHEN 'GTE' THEN amount >= coalesce(threshold, 0)
    WHEN 'LT' THEN amount < coalesce(threshold, 0) WHEN 'LTE' THEN amount <= coalesce(threshold, 0)
    WHEN 'EQ' THEN amount = coalesce(threshold, 0) WHEN 'NEQ' THEN amount <> coalesce(threshold, 0) ELSE false END
  WHEN 'account_id' THEN coalesce(CASE operator WHEN 'EQ' THEN account_id = value WHEN 'NEQ' THEN account_id <> value END, false)
  ELSE false END"""


def _first_match(order: str, where: str = "true", rules: str = "active") -> str:
    return f"""hit AS (
  SELECT transaction_id, rule_id, action FROM (
    SELECT tx.transaction_id, r.rule_id, r.action,
      row_number() OVER (PARTITION BY tx.transaction_id ORDER BY {order}) AS rn
    FROM tx JOIN {rules} r ON {where} AND ({MATCH})
  ) WHERE rn = 1
), ruled AS (
  SELECT tx.*, hit.rule_id AS rule_hit,
    CASE WHEN hit.rule_id IS NULL THEN NULL WHEN hit.action = 'BLOCK' THEN 'BLOCK' ELSE 'ALERT' END AS rule_status
  FROM tx LEFT JOIN hit USING (transaction_id)
)"""


RULED = _first_match("r.rule_id")
QUALIFIES = {
    "HIGH_FREQUENCY": "amount > 100000000 AND status = 'Approved'",
    "DECLINED_BURST": "lower(status) = 'declined'",
    "RAPID_MICROPAYMENTS": "amount BETWEEN 2000 AND 10000",
}


def _earlier(seconds: int) -> str:
    return (
        f"b.account_id = a.account_id AND b.ms >= a.ms - {seconds * 1000} "
        "AND (b.ms < a.ms OR (b.ms = a.ms AND b.transaction_id <= a.transaction_id))"
    )


def _count_hits(out: str, source: str, qualifies: str, n: int, seconds: int) -> str:
    """Ids in ``source`` that are the n-th qualifying row, or more, in their window."""
    return f"""{out}_q AS MATERIALIZED (SELECT * FROM {source} WHERE {qualifies}), {out} AS MATERIALIZED (
  SELECT a.transaction_id FROM {out}_q a JOIN {out}_q b ON {_earlier(seconds)}
  GROUP BY a.transaction_id HAVING count(*) >= {n}
)"""


def _location_hits(out: str, source: str, seconds: int) -> str:
    return f"""{out} AS MATERIALIZED (
  SELECT a.transaction_id FROM {source} a JOIN {source} b ON {_earlier(seconds)}
  GROUP BY a.transaction_id HAVING count(DISTINCT b.location_name) >= 2
)"""


def _cascade(reaches: str, new: str = "") -> str:
    """CTEs from ``p0``; ``lj``, ``hf``, ``db`` and ``rm`` hold the ids each pattern takes. With a condition ``new``, rows
    that do not meet it keep the pattern that ``settled`` gives them."""
    def taken_by(name, pattern, hits):
        if not new:
            return hits(name)
        return hits(f"{name}_all") + f""", {name} AS MATERIALIZED (
  SELECT transaction_id FROM p0 JOIN {name}_all USING (transaction_id) WHERE {new}
  UNION ALL SELECT transaction_id FROM settled WHERE cep_pattern = '{pattern}'
)"""

    steps = [f"p0 AS MATERIALIZED ({reaches})", taken_by("lj", "LOCATION_JUMP", lambda out: _location_hits(out, "p0", 3600))]
    hits = [("hf", "HIGH_FREQUENCY", 3600), ("db", "DECLINED_BURST", 1800), ("rm", "RAPID_MICROPAYMENTS", 1800)]
    before, taken = "p0", "lj"
    for i, (name, pattern, seconds) in enumerate(hits, 1):
        steps.append(f"p{i} AS MATERIALIZED (SELECT * FROM {before} WHERE transaction_id NOT IN (SELECT transaction_id FROM {taken}))")
        steps.append(taken_by(name, pattern, lambda out: _count_hits(out, f"p{i}", QUALIFIES[pattern], 3, seconds)))
        before, taken = f"p{i}", name
    return ", ".join(steps) + """, cep AS (
  SELECT transaction_id, 'LOCATION_JUMP' AS cep_pattern, 'BLOCK' AS cep_status FROM lj UNION ALL
  SELECT transaction_id, 'HIGH_FREQUENCY', 'BLOCK' FROM hf UNION ALL
  SELECT transaction_id, 'DECLINED_BURST', 'ALERT' FROM db UNION ALL
  SELECT transaction_id, 'RAPID_MICROPAYMENTS', 'ALERT' FROM rm
)"""


DECIDED = f"""{TX}, {UPDATES}, {RULED}, {_cascade(
    "SELECT * FROM ruled WHERE rule_hit IS NULL AND account_id NOT IN ('ACC_00003', 'ACC_00011')"
)}, staged AS (
  SELECT ruled.* EXCLUDE (ml_score), cep_pattern, cep_status,
    CASE WHEN rule_hit IS NOT NULL THEN 'RULE' WHEN account_id IN ('ACC_00003', 'ACC_00011') THEN 'PRIORITY'
      WHEN cep_pattern IS NOT NULL THEN 'CEP' ELSE 'ML' END AS stage, ml_score AS raw_score
  FROM ruled LEFT JOIN cep USING (transaction_id)
), decided AS (
  SELECT *, CASE WHEN stage = 'ML' THEN raw_score END AS ml_score,
    CASE stage WHEN 'RULE' THEN rule_status WHEN 'PRIORITY' THEN 'APPROVED' WHEN 'CEP' THEN cep_status
      ELSE CASE WHEN raw_score >= 0.9184e0 THEN 'ALERT' ELSE 'APPROVED' END END AS decision
  FROM staged
)"""


def _alone(hits: str) -> str:
    return f"""WITH {TX}, {hits} SELECT tx.transaction_id, tx.account_id, h.transaction_id IS NOT NULL AS fired
FROM tx LEFT JOIN h USING (transaction_id)"""


LABELLED = f"""lab AS (
  SELECT *, location_name = ({_names(DOMESTIC_LOCATIONS)})[CAST(user_id % 5 AS INTEGER) + 1] AS is_home,
    location_name IN {_IN(DOMESTIC_LOCATIONS)} AS is_domestic FROM tx
)"""


def _feature_select(source: str, average: str = "round(avg24, 4)", gap_digits: int = 6) -> str:
    return f"""SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount,
  CAST(extract(hour FROM event_time) AS DOUBLE) AS hour_of_day, CAST(CAST(home AS INTEGER) AS DOUBLE) AS is_home,
  CAST(CAST(domestic AS INTEGER) AS DOUBLE) AS is_domestic, {average} AS avg_amount_24h,
  round(CASE WHEN avg24 > 0 THEN ln(1 + amount / avg24) ELSE ln(2.0e0) END, 6) AS log_amount_ratio_24h,
  CAST(n1 AS DOUBLE) AS tx_count_1h, CAST(n3 AS DOUBLE) AS tx_count_3h,
  round(gap, {gap_digits}) AS time_since_last_tx_sec FROM {source}"""


def _arrival_features(source: str, key: str, per_s: int, include: str, gap_limit_s: int | None, first_home: str) -> str:
    """Windows over earlier arrivals, by a self-join."""
    limit = f" AND b.{key} >= a.{key} - {gap_limit_s * per_s}" if gap_limit_s else ""
    return f"""pairs AS (
  SELECT a.transaction_id,
    CAST(sum(b.amount) FILTER (WHERE b.{key} >= a.{key} - {86400 * per_s} AND {include}) AS DOUBLE)
      / count(*) FILTER (WHERE b.{key} >= a.{key} - {86400 * per_s} AND {include}) AS avg24,
    sum(b.amount) FILTER (WHERE b.{key} >= a.{key} - {86400 * per_s} AND {include}) AS sum24,
    count(*) FILTER (WHERE b.{key} >= a.{key} - {86400 * per_s} AND {include}) AS n24,
    count(b.transaction_id) FILTER (WHERE b.{key} >= a.{key} - {3600 * per_s}) AS n1,
    count(b.transaction_id) FILTER (WHERE b.{key} >= a.{key} - {10800 * per_s}) AS n3,
    max(b.{key}) FILTER (WHERE true{limit}) AS prev,
    count(b.transaction_id) AS n_before
  FROM {source} a LEFT JOIN {source} b ON b.account_id = a.account_id
    AND (b.{key} < a.{key} OR (b.{key} = a.{key} AND b.transaction_id < a.transaction_id))
  GROUP BY a.transaction_id
), homes AS (
  SELECT account_id, arg_min(location_name, (us, transaction_id)) AS home_name FROM {source} GROUP BY account_id
), feat AS (
  SELECT t.*, coalesce(avg24, CAST(amount AS DOUBLE)) AS avg24, sum24, n24, n1, n3,
    coalesce((t.{key} - prev) / CAST({per_s} AS DOUBLE), 0) AS gap,
    location_name IN {_IN(DOMESTIC_LOCATIONS)} AS domestic,
    CASE WHEN n_before = 0 THEN {first_home} ELSE location_name = home_name END AS home
  FROM {source} t JOIN pairs USING (transaction_id) JOIN homes USING (account_id)
)"""


_DOMESTIC = f"location_name IN {_IN(DOMESTIC_LOCATIONS)}"
_BY_SCORE = f"""WITH {TX}, {DEC}, {LOG}, s AS (SELECT * FROM log WHERE ml_score IS NOT NULL)"""
_CURVE = f"""{_BY_SCORE}, g AS (
  SELECT ml_score AS threshold, count(*) FILTER (WHERE is_fraud) AS pos, count(*) AS n FROM s GROUP BY 1
), c AS (
  SELECT threshold, pos, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS m,
    sum(pos) OVER () AS p FROM g
), f AS (
  SELECT threshold, CAST(tp AS DOUBLE) / m AS precision, CAST(tp AS DOUBLE) / p AS recall FROM c
)"""
_CAUGHT = "decision <> 'APPROVED'"

# Messages: the same texts, then the same checks through JSON functions.
MESSAGES = f"""m0 AS (
  SELECT id, id % 13 AS k, md5(transaction_id) AS h, strftime(produced_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
    account_id, card_id, channel, location_name, status,
    CAST(amount AS VARCHAR) || CASE WHEN id % 4 = 0 THEN '.75' ELSE '' END AS amt FROM tx
), m1 AS (
  SELECT *, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS uuid FROM m0
), m2 AS (
  SELECT id, k, '{{' || concat_ws(',',
    '"transaction_id":"' || CASE WHEN k = 8 THEN uuid[1:20] ELSE uuid END || '"',
    '"produced_at":"' || iso || '"',
    '"event_time":"' || CASE WHEN k = 7 THEN 'yesterday' ELSE iso END || '"',
    '"account_id":"' || CASE WHEN k = 2 THEN 'X' ELSE '' END || account_id || '"',
    CASE WHEN k = 9 THEN '"card_id":"CARD"' WHEN k <> 4 THEN '"card_id":"' || card_id || '"' END,
    '"amount":' || CASE WHEN k = 5 THEN '"' || amt || '"' ELSE amt END,
    '"channel":"' || CASE WHEN k = 3 THEN 'WEB' ELSE channel END || '"',
    '"location_name":"' || location_name || '"',
    CASE WHEN k = 6 THEN '"status":null' WHEN k = 9 THEN '"status":"approved"' ELSE '"status":"' || status || '"' END,
    CASE WHEN k = 1 THEN '"is_fraud":true' END) || '}}' AS body FROM m1
), msg AS (
  SELECT CASE WHEN k = 0 THEN body[1:-2] WHEN k = 10 THEN '[' || body || ']' ELSE body END AS value,
    id AS "offset", CAST(id % 10 AS INTEGER) AS partition FROM m2
), doc AS (
  SELECT *, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS obj,
    CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM msg
)"""


def _check(name: str, kind: str, test: str, message: str, required: bool = True) -> str:
    types = {"string": "('VARCHAR')", "number": "('UBIGINT', 'BIGINT', 'DOUBLE')", "boolean": "('BOOLEAN')"}
    label = kind if message != "int" else "integer"
    typed = f"json_type(j, '$.{name}') IN {types[kind]}"
    there = f"json_exists(j, '$.{name}')"
    out = f"CASE WHEN NOT {there} THEN '{name}: required but missing' END, " if required else ""
    out += f"CASE WHEN {there} AND NOT ({typed}) THEN '{name}: must be of type {label}' END"
    if test:
        text = f"json_extract_string(j, '$.{name}')"
        body = f"{name}: must be of type integer" if message == "int" else f"{name}: {message}"
        out += f", CASE WHEN {there} AND {typed} AND NOT ({test.format(v=text)}) THEN '{body}' END"
    return out


_UUID = "regexp_full_match({v}, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')"
_STAMP = "TRY_CAST({v} AS TIMESTAMPTZ) IS NOT NULL"
_braced = lambda p: p.replace("{", "{{").replace("}", "}}")
_TX_CHECKS = ", ".join([
    _check("transaction_id", "string", _UUID, "must be a uuid"),
    _check("produced_at", "string", _STAMP, "must be a date-time"),
    _check("event_time", "string", _STAMP, "must be a date-time"),
    _check("account_id", "string", f"regexp_matches({{v}}, '{_braced(ACCOUNT_ID_PATTERN)}')", f"must match {ACCOUNT_ID_PATTERN}"),
    _check("card_id", "string", f"regexp_matches({{v}}, '{_braced(CARD_ID_PATTERN)}')", f"must match {CARD_ID_PATTERN}"),
    _check("amount", "number", "", ""),
    _check("channel", "string", "{v} IN ('ATM', 'POS', 'ONLINE')", "must be one of ATM, POS, ONLINE"),
    _check("location_name", "string", "", ""),
    _check("status", "string", "{v} IN ('Approved', 'Declined')", "must be one of Approved, Declined"),
])
_TX_KEYS = ["transaction_id", "produced_at", "event_time", "account_id", "card_id", "amount", "channel", "location_name", "status"]
_RULE_KEYS = ["rule_id", "field", "operator", "threshold", "value", "action", "enabled"]


def _checked(checks: str, keys: list[str]) -> str:
    extra = f"list_transform(list_filter(json_keys(j), lambda k: NOT list_contains({keys}, k)), lambda k: k || ': not allowed')"
    return f"""checked AS (
  SELECT *, CASE WHEN NOT ok THEN 'not valid JSON' WHEN NOT obj THEN 'must be an object'
    ELSE array_to_string(list_concat(list_filter([{checks}], lambda x: x IS NOT NULL), {extra}), '; ') END AS error_message
  FROM doc
)"""


PARSED = f"WITH {TX}, {MESSAGES}, {_checked(_TX_CHECKS, _TX_KEYS)}"
RULE_MESSAGES = """msg AS (
  SELECT concat('{"rule_id":"R', p_size, '","field":"', (['amount', 'account_id', 'channel'])[CAST(p_partkey % 3 AS INTEGER) + 1],
    '","operator":"', (['GT', 'GTE', 'LT', 'LTE', 'EQ', 'NEQ', 'IN'])[CAST(p_partkey % 7 AS INTEGER) + 1], '"',
    CASE p_partkey % 5 WHEN 0 THEN concat(',"threshold":', p_size, '000') WHEN 1 THEN concat(',"threshold":', p_size, '.5')
      WHEN 2 THEN concat(',"value":"ACC_000', p_size, '"') ELSE '' END,
    ',"action":"', CASE WHEN p_partkey % 11 = 0 THEN 'LOG' WHEN p_partkey % 2 = 0 THEN 'BLOCK' ELSE 'ALERT' END,
    CASE WHEN p_partkey % 17 = 0 THEN '"}' ELSE concat('","enabled":', CASE WHEN p_partkey % 4 = 0 THEN 'false' ELSE 'true' END, '}') END) AS value,
    p_partkey AS "offset" FROM part
), doc AS (SELECT *, true AS ok, true AS obj, CAST(value AS JSON) AS j FROM msg)"""
_RULE_CHECKS = ", ".join([
    _check("rule_id", "string", "", ""),
    _check("field", "string", "{v} IN ('amount', 'account_id')", "must be one of amount, account_id"),
    _check("operator", "string", "{v} IN ('GT', 'GTE', 'LT', 'LTE', 'EQ', 'NEQ')", "must be one of GT, GTE, LT, LTE, EQ, NEQ"),
    _check("threshold", "number", "CAST({v} AS DOUBLE) = floor(CAST({v} AS DOUBLE))", "int", required=False),
    _check("value", "string", "", "", required=False),
    _check("action", "string", "{v} IN ('BLOCK', 'ALERT')", "must be one of BLOCK, ALERT"),
    _check("enabled", "boolean", "", ""),
])
_SENT = "sent AS (SELECT concat(rule_id, '#', seq) AS rule_id, value AS account_id, updated_us FROM upd WHERE field = 'account_id' AND enabled)"
_PROPAGATION = f"""WITH {TX}, {DEC}, {UPDATES}, {_SENT}, found AS (
  SELECT s.rule_id, s.account_id, min(d.decided_us) AS first_block_us, min(d.decided_us) // 1000 - any_value(s.updated_us) // 1000 AS latency_ms
  FROM sent s JOIN dec d ON d.account_id = s.account_id AND d.decision = 'BLOCK' AND d.us >= s.updated_us
  GROUP BY s.rule_id, s.account_id
)"""
_SPLIT = f"""acc AS (SELECT account_id, bool_or(is_fraud) AS has_fraud FROM lab GROUP BY 1), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY has_fraud ORDER BY md5('42:' || account_id), account_id) AS r,
    count(*) OVER (PARTITION BY has_fraud) AS n FROM acc
), parts AS (SELECT account_id, has_fraud, CASE WHEN r <= floor(n * 0.8e0) THEN 'train' ELSE 'test' END AS part FROM ranked)"""


def _hits_in(log: str, condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


ORACLES: dict[str, str] = {
    "active_rules": f"WITH {UPDATES} SELECT rule_id, field, operator, threshold, value, action, seq FROM active",
    "rules_first_match": f"WITH {TX}, {UPDATES}, {RULED} SELECT transaction_id, rule_hit, rule_status FROM ruled",
    "rules_first_match_joined": f"""WITH {TX}, {UPDATES}, {_first_match("r.action <> 'BLOCK', r.rule_id")}
SELECT transaction_id, rule_hit, rule_status FROM ruled""",
    "rules_asof": f"""WITH {TX}, {UPDATES}, versions AS (
  SELECT *, lead(updated_us) OVER (PARTITION BY rule_id ORDER BY seq) AS until_us FROM upd
), {_first_match("r.rule_id", "r.enabled AND r.updated_us <= tx.us AND (r.until_us IS NULL OR tx.us < r.until_us)", "versions")}
SELECT transaction_id, rule_hit, rule_status FROM ruled""",
    "rules_asof_many": f"""WITH {TX}, {MANY_UPDATES}, versions AS (
  SELECT *, lead(updated_us) OVER (PARTITION BY rule_id ORDER BY seq) AS until_us FROM upd
), {_first_match("r.rule_id", "r.enabled AND r.updated_us <= tx.us AND (r.until_us IS NULL OR tx.us < r.until_us)", "versions")}
SELECT transaction_id, rule_hit, rule_status FROM ruled""",
    "rule_numeric_ops": f"""WITH {TX} SELECT channel, count(*) FILTER (WHERE amount > 5000000) AS gt,
  count(*) FILTER (WHERE amount >= 5000000) AS gte, count(*) FILTER (WHERE amount < 5000000) AS lt,
  count(*) FILTER (WHERE amount <= 5000000) AS lte, count(*) FILTER (WHERE amount = 5000000) AS eq,
  count(*) FILTER (WHERE amount <> 5000000) AS neq, CAST(0 AS BIGINT) AS "in", count(*) FILTER (WHERE amount > 0) AS gt_missing
FROM tx GROUP BY channel""",
    "rule_string_ops": f"""WITH {TX} SELECT channel, count(*) FILTER (WHERE account_id = 'ACC_00007') AS eq,
  count(*) FILTER (WHERE account_id <> 'ACC_00007') AS neq, CAST(0 AS BIGINT) AS gt, CAST(0 AS BIGINT) AS neq_missing
FROM tx GROUP BY channel""",
    "rule_propagation": f"{_PROPAGATION} SELECT * FROM found",
    "rule_propagation_mean": f"{_PROPAGATION} SELECT round(avg(latency_ms), 3) AS mean_latency_ms, count(*) AS runs FROM found",
    "cep_location_jump": _alone(_location_hits("h", "tx", 3600)),
    "cep_high_frequency": _alone(_count_hits("h", "tx", QUALIFIES["HIGH_FREQUENCY"], 3, 3600)),
    "cep_declined_burst": _alone(_count_hits("h", "tx", QUALIFIES["DECLINED_BURST"], 3, 1800)),
    "cep_rapid_micropayments": _alone(_count_hits("h", "tx", QUALIFIES["RAPID_MICROPAYMENTS"], 3, 1800)),
    "cep_windowed_count": _alone(_count_hits("h", "tx", "channel = 'ONLINE'", 4, 7200)),
    "cep_cascade": f"""WITH {TX}, {_cascade("SELECT * FROM tx")}
SELECT transaction_id, cep_pattern FROM tx LEFT JOIN cep USING (transaction_id)""",
    "decide": f"""WITH {DECIDED} SELECT transaction_id, account_id, amount, rule_hit, cep_pattern, round(ml_score, 4) AS ml_score,
  us AS produced_at_us, decided_us AS decided_at_us, decision FROM decided""",
    "decision_counts": f"WITH {DECIDED} SELECT stage, decision, count(*) AS n FROM decided GROUP BY ALL",
    "alerts": f"""WITH {DECIDED} SELECT transaction_id, account_id, decision, rule_hit, cep_pattern FROM decided
WHERE decision <> 'APPROVED'""",
    "score_threshold": f"""WITH {TX} SELECT transaction_id, CASE WHEN ml_score >= 0.9184e0 THEN 'ALERT' ELSE 'APPROVED' END AS decision
FROM tx""",
    "latest_decision": f"""WITH {TX}, {DEC} SELECT account_id, transaction_id, decision, decided_us AS decided_at_us FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY decided_us DESC, transaction_id DESC) AS rn FROM dec
) WHERE rn = 1""",
    "training_features": f"""WITH {TX}, {LABELLED}, feat AS (
  SELECT *, coalesce(CAST(sum(amount) OVER day AS DOUBLE) / count(*) OVER day, CAST(amount AS DOUBLE)) AS avg24,
    count(*) OVER (PARTITION BY account_id ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS n1,
    count(*) OVER (PARTITION BY account_id ORDER BY us RANGE BETWEEN 10800000000 PRECEDING AND 1 PRECEDING) AS n3,
    coalesce((us - lag(us) OVER (PARTITION BY account_id ORDER BY us, transaction_id)) / 1e6, 0) AS gap,
    is_home AS home, is_domestic AS domestic FROM lab
  WINDOW day AS (PARTITION BY account_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING)
) {_feature_select("feat")}""",
    "serving_features": f"""WITH {TX}, {_arrival_features("tx", "ms", 1000, "b.ml_score < 0.7e0", 86400, _DOMESTIC)}
{_feature_select("feat")}""",
    "replay_features": f"""WITH {TX}, {_arrival_features("tx", "us", 1000000, "b.us IS NOT NULL", None, "true")}
{_feature_select("feat", "CASE WHEN n24 > 0 THEN ((200 * sum24 + n24) // (2 * n24)) / 100.0e0 ELSE CAST(amount AS DOUBLE) END", 1)}""",
    "home_location": f"""WITH {TX} SELECT account_id, arg_min(location_name, (us, transaction_id)) AS first_location_name
FROM tx GROUP BY account_id""",
    "total_transactions": f"WITH {TX}, {DEC}, {LOG} SELECT count(*) AS total FROM log",
    "total_transactions_window": f"WITH {TX}, {DEC} SELECT count(*) AS total FROM dec WHERE {WINDOW}",
    "latency_percentiles_window": f"""WITH {TX}, {DEC} SELECT {", ".join(
        f"round(quantile_cont(CAST(latency_ms AS DOUBLE), {p}), 4) AS {name}"
        for name, p in (("p50_ms", 0.5), ("p90_ms", 0.9), ("p95_ms", 0.95), ("p99_ms", 0.99), ("max_ms", 1))
    )} FROM dec WHERE {WINDOW}""",
    "written_decisions": f"""WITH {TX}, {DEC} SELECT CASE WHEN us % 3 = 2 THEN 0 ELSE 1 END AS batch_id, decision, count(*) AS n,
  CAST(sum(amount) AS DOUBLE) AS amount FROM dec GROUP BY 1, 2""",
    "latency_avg": f"WITH {TX}, {DEC}, {LOG} SELECT round(avg(latency_ms), 0) AS avg_latency_ms FROM log",
    "latency_percentiles": f"""WITH {TX}, {DEC}, {LOG} SELECT {", ".join(
        f"round(quantile_cont(CAST(latency_ms AS DOUBLE), {p}), 4) AS {name}"
        for name, p in (("p50_ms", 0.5), ("p90_ms", 0.9), ("p95_ms", 0.95), ("p99_ms", 0.99), ("max_ms", 1))
    )} FROM log""",
    "latency_series": f"""WITH {TX}, {DEC}, {LOG} SELECT decided_us - decided_us % 1000000 AS second_us, {", ".join(
        f"round(quantile_cont(CAST(latency_ms AS DOUBLE), {p}), 4) AS {name}" for name, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))
    )}, max(latency_ms) AS max_ms FROM log GROUP BY 1""",
    "throughput_in": f"WITH {TX}, {DEC}, {LOG} SELECT us - us % 1000000 AS second_us, count(*) AS n FROM log GROUP BY 1",
    "throughput_out": f"WITH {TX}, {DEC}, {LOG} SELECT decided_us - decided_us % 1000000 AS second_us, count(*) AS n FROM log GROUP BY 1",
    "latency_by_level": f"""WITH {TX}, {DEC}, {LOG}, busy AS (
  SELECT us - us % 3600000000 AS start_us, count(*) AS tps FROM tx GROUP BY 1
), levels AS (SELECT * FROM busy UNION ALL SELECT max(start_us) + 3600000000, 0 FROM busy)
SELECT tps, start_us, count(latency_ms) AS n, round(avg(latency_ms), 4) AS avg_ms, {", ".join(
        f"round(quantile_cont(CAST(latency_ms AS DOUBLE), {p}), 4) AS {name}" for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99))
    )}, max(latency_ms) AS max_ms
FROM levels LEFT JOIN log ON us >= start_us AND us < start_us + 2400000000 GROUP BY tps, start_us""",
    "top_slowest": f"""WITH {TX}, {DEC}, {LOG} SELECT transaction_id, account_id, decision,
  coalesce(cep_pattern, rule_hit, 'ML') AS trigger, latency_ms FROM log ORDER BY latency_ms DESC, transaction_id LIMIT 20""",
    "confusion": f"""WITH {TX}, {DEC}, {LOG} SELECT count(*) FILTER (WHERE is_fraud AND decision = 'APPROVED') AS false_negative,
  count(*) FILTER (WHERE is_fraud AND {_CAUGHT}) AS true_positive, count(*) FILTER (WHERE NOT is_fraud AND {_CAUGHT}) AS false_positive,
  count(*) FILTER (WHERE is_fraud) AS total_fraud, count(*) FILTER (WHERE NOT is_fraud) AS total_normal FROM log""",
    "detection_rates": f"""WITH {TX}, {DEC}, {LOG} SELECT
  round(count(*) FILTER (WHERE is_fraud AND {_CAUGHT}) / CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE), 6) AS detection_rate,
  round(count(*) FILTER (WHERE NOT is_fraud AND {_CAUGHT}) / CAST(count(*) FILTER (WHERE NOT is_fraud) AS DOUBLE), 6) AS wrong_detection_rate
FROM log""",
    "fdr": f"""WITH {TX}, {DEC}, {LOG} SELECT round(count(*) FILTER (WHERE is_fraud AND {_CAUGHT}) * 100.0e0
  / nullif(count(*) FILTER (WHERE is_fraud), 0), 2) AS fdr FROM log""",
    "fpr": f"""WITH {TX}, {DEC}, {LOG} SELECT round(count(*) FILTER (WHERE NOT is_fraud AND {_CAUGHT}) * 100.0e0
  / nullif(count(*) FILTER (WHERE NOT is_fraud), 0), 2) AS fpr FROM log""",
    "ml_precision": f"""{_BY_SCORE} SELECT round(count(*) FILTER (WHERE is_fraud AND decision = 'ALERT') * 100.0e0
  / nullif(count(*) FILTER (WHERE decision = 'ALERT'), 0), 2) AS ml_precision FROM s""",
    "ml_recall": f"""{_BY_SCORE} SELECT round(count(*) FILTER (WHERE is_fraud AND decision = 'ALERT') * 100.0e0
  / nullif(count(*) FILTER (WHERE is_fraud), 0), 2) AS ml_recall FROM s""",
    "ml_f1": f"""{_BY_SCORE}, pr AS (SELECT
  count(*) FILTER (WHERE is_fraud AND decision = 'ALERT') * 100.0e0 / nullif(count(*) FILTER (WHERE decision = 'ALERT'), 0) AS p,
  count(*) FILTER (WHERE is_fraud AND decision = 'ALERT') * 100.0e0 / nullif(count(*) FILTER (WHERE is_fraud), 0) AS r FROM s
) SELECT round(2 * p * r / nullif(p + r, 0), 2) AS ml_f1 FROM pr""",
    "auc_roc": f"""{_BY_SCORE}, r AS (
  SELECT is_fraud, rank() OVER (ORDER BY ml_score) + (count(*) OVER (PARTITION BY ml_score) - 1) / 2.0e0 AS rnk FROM s
) SELECT round((sum(rnk) FILTER (WHERE is_fraud) - count(*) FILTER (WHERE is_fraud) * (count(*) FILTER (WHERE is_fraud) + 1) / 2.0e0)
  / (CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) * count(*) FILTER (WHERE NOT is_fraud)), 6) AS auc_roc FROM r""",
    "auc_roc_min_rank": f"""{_BY_SCORE}, r AS (SELECT is_fraud, rank() OVER (ORDER BY ml_score) AS rnk FROM s)
SELECT round((sum(rnk) FILTER (WHERE is_fraud) - count(*) FILTER (WHERE is_fraud) * (count(*) FILTER (WHERE is_fraud) + 1) / 2.0e0)
  / (CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) * count(*) FILTER (WHERE NOT is_fraud)), 6) AS auc_roc FROM r""",
    "auc_pr": f"""{_BY_SCORE}, r AS (
  SELECT is_fraud, CAST(sum(CAST(is_fraud AS INTEGER)) OVER (ORDER BY ml_score DESC) AS DOUBLE) / count(*) OVER (ORDER BY ml_score DESC) AS p FROM s
) SELECT round(avg(p) FILTER (WHERE is_fraud), 6) AS auc_pr FROM r""",
    "auc_pr_by_row": f"""{_BY_SCORE}, r AS (
  SELECT is_fraud, CAST(sum(CAST(is_fraud AS INTEGER)) OVER w AS DOUBLE) / row_number() OVER w AS p FROM s
  WINDOW w AS (ORDER BY ml_score DESC, md5(transaction_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
) SELECT round(avg(p) FILTER (WHERE is_fraud), 6) AS auc_pr FROM r""",
    "best_threshold": f"""{_CURVE}, x AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM f)
SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM x ORDER BY x.f1 DESC, x.threshold LIMIT 1""",
    "classification_report": f"""{_BY_SCORE}, c AS (SELECT CAST(count(*) FILTER (WHERE ml_score >= 0.9184e0 AND is_fraud) AS DOUBLE) AS tp,
  count(*) FILTER (WHERE ml_score >= 0.9184e0) AS q, count(*) FILTER (WHERE is_fraud) AS p FROM s
) SELECT round(tp / q, 6) AS precision, round(tp / p, 6) AS recall, round(2 * tp / (q + p), 6) AS f1,
  tp / q > 0.80e0 AS precision_ok, tp / p > 0.75e0 AS recall_ok, 2 * tp / (q + p) > 0.78e0 AS f1_ok FROM c""",
    "error_rows": f"""WITH {TX}, {DEC}, {LOG} SELECT transaction_id, CASE WHEN is_fraud THEN 'fn' ELSE 'fp' END AS kind
FROM log WHERE is_fraud <> ({_CAUGHT})""",
    "missed_by_pattern": f"""WITH {TX}, {DEC}, {LOG} SELECT fraud_pattern, count(*) AS n FROM log
WHERE is_fraud AND decision = 'APPROVED' GROUP BY 1""",
    "missed_account_history": f"""WITH {TX}, {DEC}, {LOG} SELECT account_id, transaction_id, amount, decision, is_fraud, fraud_pattern
FROM log WHERE account_id IN (SELECT account_id FROM log WHERE is_fraud AND decision = 'APPROVED')""",
    "dataset_profile": f"""WITH {TX}, {LABELLED} SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_fraud) AS fraud_rows,
  round(count(*) FILTER (WHERE is_fraud) * 100.0e0 / count(*), 4) AS fraud_percent, count(DISTINCT account_id) AS accounts,
  min(us) AS first_event_us, max(us) AS last_event_us, count(amount) AS amount_count, round(avg(amount), 4) AS amount_mean,
  round(stddev_samp(amount), 2) AS amount_std, min(amount) AS amount_min,
  {", ".join(f"round(quantile_cont(CAST(amount AS DOUBLE), {p}), 4) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))},
  max(amount) AS amount_max FROM lab""",
    "hour_histogram": f"""WITH {TX}, {LABELLED} SELECT CASE WHEN is_fraud THEN 'Fraud' ELSE 'Normal' END AS label,
  extract(hour FROM event_time) AS hour, count(*) AS n FROM lab GROUP BY 1, 2""",
    "amount_box": f"""WITH {TX}, {LABELLED} SELECT CASE WHEN is_fraud THEN 'Fraud' ELSE 'Normal' END AS label, {", ".join(
        f"round(quantile_cont(CAST(amount AS DOUBLE), {p}), 4) AS {n}"
        for n, p in (("low", 0), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("high", 1))
    )} FROM lab GROUP BY 1""",
    "fraud_by_location": f"""WITH {TX}, {LABELLED} SELECT CASE WHEN NOT is_domestic THEN 'Foreign' WHEN NOT is_home THEN 'Other domestic'
  ELSE 'Home' END AS location_type, count(*) AS n FROM lab WHERE is_fraud GROUP BY 1""",
    "account_mean": f"""WITH {TX}, {LABELLED} SELECT account_id, round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS mean_amount
FROM lab GROUP BY 1""",
    "class_weight": f"""WITH {TX}, {LABELLED} SELECT count(*) FILTER (WHERE NOT is_fraud) // count(*) FILTER (WHERE is_fraud) AS class_weight
FROM lab""",
    "account_split": f"WITH {TX}, {LABELLED}, {_SPLIT} SELECT account_id, has_fraud, part FROM parts",
    "split_rows": f"""WITH {TX}, {LABELLED}, {_SPLIT} SELECT part, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS fraud
FROM lab JOIN parts USING (account_id) GROUP BY 1""",
    "parse_valid": f"""{PARSED} SELECT "offset", j->>'transaction_id' AS transaction_id,
  epoch_us(CAST(j->>'produced_at' AS TIMESTAMPTZ)) AS produced_at_us, epoch_us(CAST(j->>'event_time' AS TIMESTAMPTZ)) AS event_time_us,
  j->>'account_id' AS account_id, j->>'card_id' AS card_id, CAST(trunc(CAST(j->>'amount' AS DOUBLE)) AS BIGINT) AS amount,
  j->>'channel' AS channel, j->>'location_name' AS location_name, j->>'status' AS status FROM checked WHERE error_message = ''""",
    "dlq_records": f"""{PARSED} SELECT 'transactions' AS "sourceTopic", partition, "offset", value AS "rawPayload",
  error_message AS "errorMessage", '2026-01-01T00:00:00.000000Z' AS "failedAt" FROM checked WHERE error_message <> ''""",
    "parse_rules": f"""WITH {RULE_MESSAGES}, {_checked(_RULE_CHECKS, _RULE_KEYS)} SELECT "offset", error_message,
  CASE WHEN error_message = '' THEN j->>'rule_id' END AS rule_id, CASE WHEN error_message = '' THEN j->>'field' END AS field,
  CASE WHEN error_message = '' THEN j->>'operator' END AS operator,
  CASE WHEN error_message = '' THEN coalesce(CAST(CAST(j->>'threshold' AS DOUBLE) AS BIGINT), 0) END AS threshold,
  CASE WHEN error_message = '' THEN j->>'value' END AS operand, CASE WHEN error_message = '' THEN j->>'action' END AS action,
  CASE WHEN error_message = '' THEN CAST(j->>'enabled' AS BOOLEAN) END AS enabled FROM checked""",
}

# Streams end with what the batch gives.
ORACLES["decide_stream"] = ORACLES["decide"]
ORACLES["cep_stream"] = ORACLES["cep_cascade"]
ORACLES["metrics_stream"] = f"""WITH {TX} SELECT decided_us - decided_us % 1000000 AS second_us, count(*) AS n, {", ".join(
    f"quantile_disc(decided_us // 1000 - us // 1000, 0.{p}) AS p{p}" for p in (50, 90, 99)
  )},
  max(decided_us // 1000 - us // 1000) AS max_ms FROM tx GROUP BY 1"""

# The feedback between averages and decisions, one row of each account at a time.
_RECENT = "list_filter(f.hist, lambda h: h.ms >= s.ms - 86400000)"
_INCLUDED = "list_filter(f.hist, lambda h: h.ms >= s.ms - 86400000 AND h.ok)"
_OK = "CASE stage WHEN 'ML' THEN score < 0.6e0 ELSE stage = 'PRIORITY' END"


def _fold(source: str, stage: str) -> str:
    """CTEs ``seq``, ``fold`` and ``feat``; ``stage`` says which stage decides a row of ``source``."""
    return f"""seq AS (
  SELECT transaction_id, account_id, amount, ms, event_time, location_name, {stage} AS stage,
    {_DOMESTIC} AS domestic, row_number() OVER w AS k, lag(ms) OVER w AS prev, first(location_name) OVER w AS home_name FROM {source}
  WINDOW w AS (PARTITION BY account_id ORDER BY ms, transaction_id)
), fold AS (
  SELECT DISTINCT account_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS transaction_id, CAST(NULL AS DOUBLE) AS avg24,
    CAST(0 AS BIGINT) AS n1, CAST(0 AS BIGINT) AS n3, CAST(NULL AS DOUBLE) AS score, true AS approved,
    CAST([] AS STRUCT(ms BIGINT, amount BIGINT, ok BOOLEAN)[]) AS hist FROM seq
  UNION ALL
  SELECT account_id, k, transaction_id, avg24, n1, n3, CASE WHEN stage = 'ML' THEN score END,
    {_OK}, list_append(hist, {{'ms': ms, 'amount': amount, 'ok': {_OK}}})
  FROM (
    SELECT *, round(ln(1 + amount / avg24) / (1 + ln(1 + amount / avg24)) + least(n1, 9) / 100.0e0, 6) AS score FROM (
      SELECT s.account_id, s.k, s.transaction_id, s.ms, s.amount, s.stage, f.hist, len({_RECENT}) AS n24,
        len(list_filter(f.hist, lambda h: h.ms >= s.ms - 3600000)) AS n1, len(list_filter(f.hist, lambda h: h.ms >= s.ms - 10800000)) AS n3,
        CASE WHEN len({_INCLUDED}) > 0 THEN CAST(list_sum(list_transform({_INCLUDED}, lambda h: h.amount)) AS DOUBLE) / len({_INCLUDED})
          ELSE CAST(s.amount AS DOUBLE) END AS avg24
      FROM fold f JOIN seq s ON s.account_id = f.account_id AND s.k = f.k + 1
    )
  )
), feat AS (
  SELECT seq.*, avg24, n1, n3, fold.score, fold.approved, CASE WHEN seq.k = 1 THEN domestic ELSE location_name = home_name END AS home,
    CASE WHEN seq.ms - prev <= 86400000 THEN (seq.ms - prev) / 1000.0e0 ELSE 0 END AS gap
  FROM fold JOIN seq USING (transaction_id)
)"""


_FOLDED = _feature_select("feat").replace("SELECT transaction_id", "SELECT score AS ml_score, approved, transaction_id", 1)
ORACLES["sequential_serving_fold"] = f"""WITH RECURSIVE {TX}, {_fold("tx", "CASE WHEN amount > 1000000000 THEN 'RULE' ELSE 'ML' END")}
{_FOLDED}"""
ORACLES["decide_full"] = f"""WITH RECURSIVE {DECIDED}, {_fold("staged", "stage")}, folded AS ({_FOLDED})
SELECT f.* EXCLUDE (approved), rule_hit, cep_pattern, s.stage, CASE s.stage WHEN 'RULE' THEN rule_status WHEN 'PRIORITY' THEN 'APPROVED'
  WHEN 'CEP' THEN cep_status ELSE CASE WHEN f.ml_score >= 0.6e0 THEN 'ALERT' ELSE 'APPROVED' END END AS decision
FROM folded f JOIN staged s USING (transaction_id)"""

# A fitted model is only checked for what does not depend on how it is fitted.
ORACLES["model_checked"] = f"""WITH feat_rows AS ({ORACLES["training_features"]}), {TX}, {LABELLED}, {_SPLIT}
SELECT f.*, lab.is_fraud, (SELECT count(*) FILTER (WHERE NOT l.is_fraud) // count(*) FILTER (WHERE l.is_fraud) FROM lab l JOIN parts p USING (account_id)
  WHERE p.part = 'train') AS class_weight, true AS same_again, true AS same_by_trees, true AS ranks
FROM feat_rows f JOIN lab USING (transaction_id) JOIN parts ON parts.account_id = lab.account_id WHERE parts.part = 'test'"""
ORACLES["early_stopping"] = "SELECT 12 AS rounds, true AS best_in_reach, true AS same_precision"
ORACLES["metrics_by_hour"] = f"""WITH {TX} SELECT decided_us - decided_us % 3600000000 AS hour_us, count(*) AS n, {", ".join(
    f"CASE WHEN count(*) <= 1024 THEN quantile_disc(decided_us // 1000 - us // 1000, 0.{p}) END AS p{p}" for p in (50, 90, 99)
  )}, max(decided_us // 1000 - us // 1000) AS max_ms FROM tx GROUP BY 1"""
ORACLES["cep_state_left"] = f"""WITH cascade AS ({ORACLES["cep_cascade"]}), {TX}
SELECT account_id, count(*) AS n, count(cep_pattern) AS patterns,
  max(ms) + 3600000 > (SELECT max(ms) - 600000 FROM tx) AS "left" FROM tx JOIN cascade USING (transaction_id) GROUP BY account_id"""
ORACLES["account_mismatch"] = f"""WITH {TX}, acc AS (
  SELECT concat('ACC_', lpad(CAST(c_custkey AS VARCHAR), 5, '0')) AS account_id,
    concat('CARD_', lpad(CAST(c_custkey + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR), 5, '0')) AS card_id,
    CASE WHEN c_custkey % 9 <> 0 THEN ({_names(DOMESTIC_LOCATIONS)})[CAST(c_nationkey % 5 AS INTEGER) + 1] END AS home_location,
    CAST(abs(round(c_acctbal)) AS BIGINT) * 1000 AS avg_amount FROM customer WHERE c_custkey % 10 <> 0
), t AS (SELECT * EXCLUDE (account_id), concat('CARD_', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS own_card,
  CASE WHEN id % 50 <> 7 THEN account_id END AS account_id FROM tx)
SELECT t.account_id, bool_or(a.account_id IS NOT NULL) AS known, count(*) AS n, count(*) FILTER (WHERE t.own_card <> a.card_id) AS other_card,
  count(*) FILTER (WHERE t.location_name <> a.home_location) AS away, count(*) FILTER (WHERE t.amount > a.avg_amount) AS above_usual
FROM t LEFT JOIN acc a ON a.account_id = t.account_id GROUP BY t.account_id"""
ORACLES["decide_stream_scored"] = f"""WITH full_batch AS ({ORACLES["decide_full"]}) SELECT transaction_id, account_id, rule_hit, cep_pattern,
  round(CAST(CAST(CASE WHEN stage = 'ML' THEN ml_score END AS FLOAT) AS DOUBLE), 4) AS ml_score, decision FROM full_batch"""
ORACLES["dataset_union"] = f"""WITH {TX} SELECT transaction_id, account_id, amount, us AS event_time_us,
  CASE WHEN is_fraud THEN 'Fraud' ELSE 'Normal' END AS label FROM tx"""
ORACLES["dlq_stream"] = f"""{PARSED} SELECT error_message AS "errorMessage", count(*) AS n,
  CASE WHEN error_message <> '' THEN CAST(sum("offset") AS BIGINT) END AS offsets FROM checked GROUP BY error_message"""
ORACLES["rule_stream"] = f"""WITH {RULE_MESSAGES}, {_checked(_RULE_CHECKS, _RULE_KEYS)}, good AS (
  SELECT j->>'rule_id' AS rule_id, j->>'field' AS field, j->>'operator' AS operator,
    coalesce(CAST(CAST(j->>'threshold' AS DOUBLE) AS BIGINT), 0) AS threshold, j->>'value' AS operand, j->>'action' AS action,
    "offset" AS seq, CAST(j->>'enabled' AS BOOLEAN) AS enabled FROM checked WHERE error_message = ''
) SELECT * EXCLUDE (enabled, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY seq DESC) AS rn FROM good
) WHERE rn = 1 AND enabled"""

ORACLES["ranking_report"] = f"""SELECT n.*, a.auc_roc, p.auc_pr, b.* FROM (
  {_BY_SCORE} SELECT count(*) FILTER (WHERE is_fraud) AS pos, count(*) FILTER (WHERE NOT is_fraud) AS neg FROM s
) n, ({ORACLES["auc_roc"]}) a, ({ORACLES["auc_pr"]}) p, ({ORACLES["best_threshold"]}) b"""
ORACLES["truth_table"] = f"""WITH {TX} SELECT is_fraud, fraud_pattern, count(*) AS n, sum(amount) AS amount FROM tx GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*), sum(amount) FROM tx"""
ORACLES["labelled_report"] = f"""WITH {TX}, {LABELLED} SELECT account_id, count(*) AS n, sum(amount) AS amount,
  count(*) FILTER (WHERE is_fraud) AS fraud, count(*) FILTER (WHERE is_home) AS home, max(us) // 1000 * 1000 AS last_us,
  true AS in_order, true AS reset FROM lab GROUP BY account_id"""
ORACLES["source_reads"] = f"""{PARSED}, typed AS (
  SELECT *, error_message = '' AS good, CASE WHEN error_message = '' THEN CAST(trunc(CAST(j->>'amount' AS DOUBLE)) AS BIGINT) END AS amount FROM checked
) SELECT 'transactions' AS topic, 0 AS partition, good, 'text' AS source, count(*) AS n, sum(amount) AS amount, NULL AS offsets FROM typed GROUP BY good
UNION ALL SELECT 'transactions', partition, good, source, count(*), sum(amount), sum("offset")
FROM typed, (VALUES ('json'), ('parquet')) f(source) GROUP BY partition, good, source"""
ORACLES["rule_dead_letters"] = f"""WITH {RULE_MESSAGES}, {_checked(_RULE_CHECKS, _RULE_KEYS)} SELECT 'rules-updates' AS "sourceTopic",
  0 AS partition, "offset", value AS "rawPayload", error_message AS "errorMessage" FROM checked WHERE error_message <> ''"""

# Late rows are decided among all rows, and change nothing that was decided without them.
_REACHING = "rule_hit IS NULL AND account_id NOT IN ('ACC_00003', 'ACC_00011')"
_DECISION = DECIDED[DECIDED.index("staged AS ("):]
ORACLES["decide_stream_late"] = f"""WITH {TX}, {UPDATES}, {RULED}, settled AS MATERIALIZED (
  WITH {_cascade(f"SELECT * FROM ruled WHERE id % 10 <> 3 AND {_REACHING}")} SELECT * FROM cep
), {_cascade(f"SELECT * FROM ruled WHERE {_REACHING}", "id % 10 = 3")}, {_DECISION}
SELECT transaction_id, account_id, rule_hit, cep_pattern, round(CAST(CAST(ml_score AS FLOAT) AS DOUBLE), 4) AS ml_score, decision FROM decided"""
ORACLES["decide_stream_rules"] = f"""WITH {TX}, {UPDATES}, in_force AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY part, rule_id ORDER BY seq DESC) AS rn
    FROM upd JOIN range(4) p(part) ON updated_us < {BASE_US} + part * {SPAN_US // 4}
  ) WHERE rn = 1 AND enabled
), {_first_match("r.rule_id", f"r.part = greatest(0, least(3, (tx.us - {BASE_US}) // {SPAN_US // 4}))", "in_force")}
SELECT transaction_id, account_id, rule_hit, rule_status FROM ruled"""
ORACLES["decide_stream_compacted"] = f"WITH {DECIDED} SELECT transaction_id, account_id, rule_hit, cep_pattern, decision FROM decided"
