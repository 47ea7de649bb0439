"""Dynamic threshold and blacklist rules.

A rule table is control data: it is compacted to one row per rule, then turned into a lookup the transactions
pass through without being shuffled or multiplied. The first match is the one with the least ``rule_id``, or, with
``prefer_block``, the least among the blocking ones if any blocks.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.constants import ALERT, BLOCK
from riskengine.functions.predicates import action_status, rule_matches
from riskengine.functions.time import bucket
from riskengine.operators.dedup import latest_by_key
from riskengine.operators.joins import lookup_join
from riskengine.operators.steps import FAN, find_step, least_over_time, levels_for, numbered, steps_of, tree_nodes
from riskengine.session import stored

INLINE_RULES = 64
#: Versions times hours that are gathered; an hour's array holds no more, and each takes about a hundred bytes.
FEW_VERSIONS = 100_000
#: Versions in any one hour's array: every transaction of the hour tests each, so beyond this the tree takes over.
FEW_PER_HOUR = 256
_HOUR_US = 3_600_000_000
_HIT = "struct<rank:int,rule_id:string,status:string>"


def active_rules(updates: DataFrame) -> DataFrame:
    """The newest update of every rule, without the disabled ones."""
    return latest_by_key(updates, ["rule_id"], ["seq"]).filter("enabled")


def _rank(prefer_block: bool, action: Column) -> Column:
    return F.when(action == BLOCK, 0).otherwise(1) if prefer_block else F.lit(0)


def _hit(prefer_block: bool, rule_id: Column, action: Column) -> Column:
    """Comparable record of a match: its least value is the first match."""
    return F.struct(
        _rank(prefer_block, action).alias("rank"), rule_id.alias("rule_id"), action_status(action).alias("status")
    )


def _least_hit(*hits: Column) -> Column:
    return F.array_min(F.array_compact(F.array(*hits)))


def _finish(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("rule_hit", F.col("_hit.rule_id")).withColumn("rule_status", F.col("_hit.status")).drop("_hit")
    )


# A rule known when the plan is made needs only its one comparison.
_COMPARE = {
    "GT": operator.gt, "GTE": operator.ge, "LT": operator.lt, "LTE": operator.le, "EQ": operator.eq, "NEQ": operator.ne,
}


def _test(rule) -> Column | None:
    """The rule as a predicate, or None if it can never match."""
    if rule.field == "amount" and rule.operator in _COMPARE:
        return _COMPARE[rule.operator](F.col("amount"), rule.threshold or 0)
    if rule.field == "account_id" and rule.operator in ("EQ", "NEQ") and rule.value is not None:
        return _COMPARE[rule.operator](F.col("account_id"), rule.value)
    return None


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inline(rules: list, prefer_block: bool) -> Column:
    """Few rules become one CASE expression, compiled with the rest of the stage."""
    chain = F
    for rule in sorted(rules, key=lambda r: (prefer_block and r.action != BLOCK, r.rule_id)):
        test = _test(rule)
        if test is not None:
            rank = int(prefer_block and rule.action != BLOCK)
            status = BLOCK if rule.action == BLOCK else ALERT
            hit = f"named_struct('rank', {rank}, 'rule_id', {_quoted(rule.rule_id)}, 'status', '{status}')"
            chain = chain.when(test, F.expr(hit))
    return F.lit(None).cast(_HIT) if chain is F else chain


def _bounds(rules: DataFrame, *more: str) -> DataFrame:
    """Range rules as bounds of a step function of the amount, which is a whole number: ``GT 5`` holds from 6 on."""
    t, op, most = F.coalesce("threshold", F.lit(0)), F.col("operator"), F.lit(2**63 - 1)
    always = (op == "LTE") & (t == most)
    v = F.when(always, F.lit(-(2**63))).when(op.isin("GT", "LTE"), t + 1).otherwise(t)
    upward = op.isin("GT", "GTE") | always
    own = rules.filter("field = 'amount' AND operator IN ('GT', 'GTE', 'LT', 'LTE')").filter(~((op == "GT") & (t == most)))
    return own.select(*more, v.alias("v"), F.when(upward, F.col("hit")).alias("up"), F.when(~upward, F.col("hit")).alias("down"))


def _two_unequal(rules: DataFrame, *keys: str) -> DataFrame:
    """Of the unequal-to rules the first and the first with another operand, per field: between them they match
    everything that any matches."""
    operand = F.when(F.col("field") == "amount", F.coalesce("threshold", F.lit(0)).cast("string")).otherwise(F.col("value"))
    own = rules.filter("operator = 'NEQ'").withColumn("operand", operand)
    own = own.filter("field = 'amount' OR (field = 'account_id' AND value IS NOT NULL)")
    own = own.groupBy(*keys, "field", "operand").agg(F.min("hit").alias("hit"))
    order = Window.partitionBy(*keys, "field").orderBy("hit")
    return own.withColumn("_n", F.row_number().over(order)).filter("_n <= 2").drop("_n")


def _by_step(steps: list) -> Column:
    """A few steps as one CASE expression."""
    chain, amount = F, F.col("amount")
    for s in steps:
        hit = f"named_struct('rank', {s.hit.rank}, 'rule_id', {_quoted(s.hit.rule_id)}, 'status', '{s.hit.status}')"
        chain = chain.when((amount >= s.lo) if s.hi is None else (amount >= s.lo) & (amount < s.hi), F.expr(hit))
    return F.lit(None).cast(_HIT) if chain is F else chain


def _first_by(rules: DataFrame, key: str, alias: str) -> DataFrame:
    """First rule for each value of ``key``, ready for an equi-join."""
    return rules.groupBy(F.col(key).alias(alias)).agg(F.min("hit").alias(f"_by_{alias}"))


def apply_rules(
    tx: DataFrame, rules: DataFrame, prefer_block: bool = False, inline_limit: int = INLINE_RULES
) -> DataFrame:
    """Adds ``rule_hit`` and ``rule_status``, null where no active rule matches.

    ``rules`` holds one row per enabled rule. Up to ``inline_limit`` of them are read and compiled into the
    projection. Beyond that, equality rules (a blacklist may be long) are joined on the value they name, which gives
    at most one row per transaction; range rules become one step function of the amount, kept as a table and met by range
    bucket; of the unequal-to rules no more than two per field can decide.
    """
    cols = ["rule_id", "field", "operator", "threshold", "value", "action"]
    rules = rules.filter("enabled").select(*cols)
    head = rules.limit(inline_limit + 1).collect()
    if len(head) <= inline_limit:
        return _finish(tx.withColumn("_hit", _inline(head, prefer_block)))

    rules = rules.withColumn("hit", _hit(prefer_block, F.col("rule_id"), F.col("action")))
    by_account = rules.filter("field = 'account_id' AND operator = 'EQ' AND value IS NOT NULL")
    by_amount = rules.filter("field = 'amount' AND operator = 'EQ'").withColumn(
        "threshold", F.coalesce("threshold", F.lit(0))
    )
    # At most four rows.
    unequal = [
        F.when(F.col(r.field).cast("string") != r.operand, F.struct(*[F.lit(v).alias(n) for n, v in r.hit.asDict().items()]))
        for r in _two_unequal(rules).collect()
    ]
    joined = tx
    for named, operand, key in ((by_account, "value", "account_id"), (by_amount, "threshold", "amount")):
        joined = lookup_join(joined, _first_by(named, operand, key), key, "left", "transaction_id")
    ranges = steps_of(_bounds(rules))
    few = ranges.limit(INLINE_RULES + 1).collect()
    if len(few) <= INLINE_RULES:
        joined = joined.withColumn("_by_range", _by_step(few))
    else:
        ranges = stored(ranges.withColumnRenamed("hit", "_by_range"), "rule-steps")
        joined = find_step(joined, ranges, "amount", ["_by_range"], "transaction_id")
    hit = _least_hit(F.col("_by_account_id"), F.col("_by_amount"), F.col("_by_range"), *unequal)
    return _finish(joined.withColumn("_hit", hit.cast(_HIT))).select(*tx.columns, "rule_hit", "rule_status")


def rule_versions(updates: DataFrame) -> DataFrame:
    """Each enabled update with the span it was in force, ``[valid_from, valid_to)`` in epoch microseconds."""
    following = Window.partitionBy("rule_id").orderBy("seq")
    return (
        updates.withColumn("valid_from", F.unix_micros("updated_at"))
        .withColumn("valid_to", F.lead("valid_from").over(following))
        .filter("enabled AND (valid_to IS NULL OR valid_from < valid_to)")
        .drop("seq", "updated_at", "enabled")
    )


def _by_hour(versions: DataFrame, last: int) -> DataFrame:
    """Versions gathered by hour. Hours after the last change share its array."""
    until = F.least(F.coalesce(bucket("valid_to - 1", _HOUR_US), F.lit(last)), F.lit(last))
    version = F.struct("hit", "field", "operator", "threshold", "value", "valid_from", "valid_to")
    return versions.withColumn("_hour", F.explode(F.sequence(bucket("valid_from", _HOUR_US), until))).groupBy("_hour").agg(
        F.sort_array(F.collect_list(version)).alias("_versions")
    )


def _asof_few(tx: DataFrame, lookup: DataFrame, time_col: str, last: int) -> DataFrame:
    """Versions gathered by hour (:func:`_by_hour`), met by a broadcast of the hours."""
    tx = tx.withColumn("_t", F.unix_micros(time_col))
    tx = tx.withColumn("_hour", F.least(bucket("_t", _HOUR_US), F.lit(last)))

    def in_force(v: Column) -> Column:
        alive = (v.valid_from <= F.col("_t")) & (v.valid_to.isNull() | (F.col("_t") < v.valid_to))
        return alive & rule_matches(v.field, v.operator, v.threshold, v.value)

    hits = F.transform(F.filter("_versions", in_force), lambda v: v.hit)
    joined = lookup_join(tx, lookup, "_hour", "left", "transaction_id")
    return _finish(joined.withColumn("_hit", F.array_min(hits))).drop("_hour", "_t", "_versions")


def apply_rules_asof(
    tx: DataFrame, updates: DataFrame, time_col: str = "produced_at", prefer_block: bool = False, few: int = FEW_VERSIONS
) -> DataFrame:
    """:func:`apply_rules` with the rules that were in force at each row's ``time_col``.

    Few versions (``few`` at most, counted once for every hour that they touch, and no more than ``FEW_PER_HOUR`` in any
    hour) are gathered by hour and tested one by one; the bound per hour keeps each transaction's tests from growing with
    the rule table.
    Beyond, rules may be of any number. Equality rules become steps in time per value that they name. For the others, the times at
    which rules change are numbered, and a rule holds over a run of numbers that is taken apart into nodes of a tree of
    fan-out 16; each node has the step function of the amount of its own range rules, and at most two unequal-to rules per
    field. A transaction looks up its number, then one node per level. All lookups are joins that are broadcast if small
    in rows and bytes and spread if not; nothing is gathered into arrays or read by the driver.
    """
    versions = rule_versions(updates).withColumn("hit", _hit(prefer_block, F.col("rule_id"), F.col("action")))
    hour_from, hour_to = bucket("valid_from", _HOUR_US), bucket("valid_to - 1", _HOUR_US)
    seen = versions.agg(
        F.max(F.greatest(hour_from, F.coalesce(bucket("valid_to", _HOUR_US), hour_from))).alias("last"),
        F.sum(F.coalesce(hour_to, hour_from) - hour_from + 1).alias("hours"), F.count_if(F.col("valid_to").isNull()).alias("open"),
        F.min(hour_from).alias("first"),
    ).first()
    if seen.last is not None and seen.hours + seen.open * (seen.last - seen.first + 1) <= few:
        lookup = _by_hour(versions, seen.last)
        if lookup.agg(F.max(F.size("_versions"))).first()[0] <= FEW_PER_HOUR:
            return _asof_few(tx, lookup, time_col, seen.last)
    versions = stored(versions.select("field", "operator", "threshold", "value", "valid_from", "valid_to", "hit"), "rule-versions")
    joined = tx.withColumn("_t", F.unix_micros(time_col))
    hits = []
    for field, operand, key in (("account_id", F.col("value"), "account_id"), ("amount", F.coalesce("threshold", F.lit(0)), "amount")):
        named = versions.filter((F.col("field") == field) & (F.col("operator") == "EQ")).withColumn(key, operand).filter(F.col(key).isNotNull())
        steps = stored(least_over_time(named.select(key, "valid_from", "valid_to", "hit"), key).withColumnRenamed("hit", f"_by_{key}"), "rule-steps")
        joined = find_step(joined, steps, "_t", [f"_by_{key}"], "transaction_id", [key])
        hits.append(F.col(f"_by_{key}"))

    rest = versions.filter("(field = 'amount' AND operator IN ('GT', 'GTE', 'LT', 'LTE')) OR operator = 'NEQ'")
    times = rest.select(F.col("valid_from").alias("at")).union(rest.filter("valid_to IS NOT NULL").select("valid_to")).distinct()
    changes = stored(numbered(times), "rule-changes")
    n = changes.count()
    if n:
        levels = levels_for(n + 1)
        begin = changes.select(F.col("lo").alias("valid_from"), F.col("_leaf").alias("_i"))
        end = changes.select(F.col("lo").alias("valid_to"), F.col("_leaf").alias("_j"))
        covered = rest.join(begin, "valid_from").join(end, "valid_to", "left").withColumn("_j", F.coalesce("_j", F.lit(n)))
        nodes = stored(covered.select("field", "operator", "threshold", "value", "hit", F.inline(tree_nodes("_i", "_j", levels))), "rule-nodes")
        ranges = stored(steps_of(_bounds(nodes, "level", "node"), ["level", "node"]), "rule-steps")
        unequal = stored(_two_unequal(nodes, "level", "node"), "rules-unequal")
        kinds = [r.field for r in unequal.select("field").distinct().collect()]
        present = {r.level for r in ranges.select("level").distinct().collect()}
        joined = find_step(joined, changes, "_t", ["_leaf"], "transaction_id")
        for level in range(levels):
            joined = joined.withColumn("_node", F.expr(f"_leaf div {FAN**level}L"))
            if level in present:
                own = ranges.filter(F.col("level") == level).select(F.col("node").alias("_node"), "lo", "hi", F.col("hit").alias(f"_range{level}"))
                joined = find_step(joined, own, "amount", [f"_range{level}"], "transaction_id", ["_node"])
                hits.append(F.col(f"_range{level}"))
            for field in kinds:
                # The two rules of a node side by side, so a transaction meets one row.
                own = unequal.filter((F.col("level") == level) & (F.col("field") == field)).groupBy(F.col("node").alias("_node"))
                pair = own.agg(F.min(F.struct("hit", "operand")).alias("_one"), F.max(F.struct("hit", "operand")).alias("_two"))
                names = [f"_{field}{level}_{i}" for i in ("one", "two")]
                pair = pair.withColumnsRenamed({"_one": names[0], "_two": names[1]})
                joined = lookup_join(joined, pair, "_node", "left", "transaction_id")
                hits += [F.when(F.col(field).cast("string") != F.col(f"{c}.operand"), F.col(f"{c}.hit")) for c in names]
    found = joined.withColumn("_hit", _least_hit(*[h.cast(_HIT) for h in hits]))
    return _finish(found).select(*tx.columns, "rule_hit", "rule_status")
