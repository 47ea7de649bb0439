"""The patterns as a stateful stream operator, for low latency without dynamic rules.

Every pattern's test needs only a few figures of what came before (the latest times), so the state of an account
has a fixed size, however busy the account is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskengine.functions.time import epoch
from riskengine.operators.cep import CepConfig, ChangePattern

OUTPUT = "transaction_id string, account_id string, cep_pattern string"
# Latest times per pattern: up to n - 1 of them, or, for a change pattern, its last value's and another value's.
STATE = "times array<array<bigint>>, last_values array<string>"
EXPIRY = "at bigint"


def _steps(config: CepConfig) -> list[tuple]:
    """(name, is_change, window in ms, times kept) per pattern; plain data, as it travels to the workers."""
    return [
        (p.name, isinstance(p, ChangePattern), p.window_s * 1000, 2 if isinstance(p, ChangePattern) else p.threshold - 1)
        for p in config.patterns
    ]


def advance(steps: list[tuple], times: list, values: list, ms: int, tests: list) -> str | None:
    """Takes one row through the cascade, updating ``times`` and ``values``; returns the pattern that fires.

    ``tests`` holds, per pattern, the row's value (change) or whether it qualifies (count).
    """
    for i, (name, is_change, window, keep) in enumerate(steps):
        seen, test = times[i], tests[i]
        if is_change:
            # seen = [time of the last value, time of another value], either may be missing.
            others = seen[1:] if seen and values[i] == test else seen[:1]
            fires = any(ms - t <= window for t in others)
            if seen and values[i] != test:
                times[i] = [ms, seen[0]] if ms >= seen[0] else [seen[0], max([ms, *seen[1:]])]
                values[i] = test if ms >= seen[0] else values[i]
            else:
                times[i] = [max([ms, *seen[:1]]), *seen[1:]]
                values[i] = test
        elif not test:
            continue
        else:
            fires = len(seen) >= keep and all(ms - t <= window for t in seen)
            times[i] = sorted([*seen, ms], reverse=True)[:keep]
        if fires:
            return name
    return None


class PatternProcessor(StatefulProcessor):
    """``keep_ms``: how long after an account's newest row its state is of use to any later row, by event time; once the
    watermark has passed that, a timer clears it. ``ttl_ms``: the same by the clock, kept by the state store."""

    def __init__(self, steps: list[tuple], keep_ms: int | None = None, ttl_ms: int | None = None):
        self.steps, self.keep_ms, self.ttl_ms = steps, keep_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("patterns", STATE, self.ttl_ms)
        if self.keep_ms is not None:
            self.expiry = handle.getValueState("expiry", EXPIRY)

    def _keep_until(self, at: int) -> None:
        """One timer per account, moved on as newer rows come; a late row moves nothing. Every state call is a round trip
        to the JVM, so ``get`` (None when there is none) stands for ``exists`` too."""
        stored = self.expiry.get()
        if stored is not None:
            before = stored[0]
            if before >= at:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)
        self.expiry.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        self.expiry.clear()
        yield pd.DataFrame({"transaction_id": [], "account_id": [], "cep_pattern": []}, dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = len(self.steps)
        times, values = [[] for _ in range(n)], [None] * n
        stored = self.state.get()
        if stored is not None:
            times, values = [list(t) for t in stored[0]], list(stored[1])
        # Rows of one account come in any order within a batch.
        batch = pd.concat(list(rows)).sort_values(["ms", "transaction_id"])
        tests = [batch[f"t{i}"].tolist() for i in range(n)]
        hits = [
            advance(self.steps, times, values, ms, row) for ms, row in zip(batch["ms"].tolist(), zip(*tests))
        ]
        self.state.update((times, values))
        if self.keep_ms is not None:
            self._keep_until(int(batch["ms"].max()) + self.keep_ms)
        yield pd.DataFrame({
            "transaction_id": batch["transaction_id"].to_numpy(), "account_id": key[0],
            "cep_pattern": pd.Series(hits, dtype=object).to_numpy(),
        })

    def close(self) -> None:
        pass


def cep_stream(
    transactions: DataFrame, config: CepConfig = CepConfig(), late: str | None = None, ttl_s: int | None = None
) -> DataFrame:
    """Streaming twin of ``cep_decide``. Needs the RocksDB state store.

    Without more, state is kept for ever and no row is late. With ``late``, an account's state ends when the watermark,
    ``late`` behind the newest row, has left its longest window; rows later than that are dropped by the engine. With
    ``ttl_s``, state ends so many seconds after its last change by the clock.
    """
    tests = [
        (F.col(p.column) if isinstance(p, ChangePattern) else F.coalesce(p.qualifies(), F.lit(False))).alias(f"t{i}")
        for i, p in enumerate(config.patterns)
    ]
    if late is not None:
        transactions = transactions.withWatermark("event_time", late)
    rows = transactions.select("account_id", "transaction_id", "event_time", epoch("event_time").alias("ms"), *tests)
    keep_ms = None if late is None else max(p.window_s for p in config.patterns) * 1000
    mode = "EventTime" if late is not None else "ProcessingTime" if ttl_s is not None else "None"
    processor = PatternProcessor(_steps(config), keep_ms, None if ttl_s is None else ttl_s * 1000)
    return rows.groupBy("account_id").transformWithStateInPandas(processor, OUTPUT, outputMode="Append", timeMode=mode)


def stored_accounts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The accounts that a stopped stream has state for."""
    state = spark.read.format("statestore").option("stateVarName", "patterns").load(checkpoint)
    return state.select(F.col("key.account_id").alias("account_id"))
