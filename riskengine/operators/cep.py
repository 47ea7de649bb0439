"""Per-account sequence patterns and their cascade.

Each pattern remembers the rows that reached it, and tests every new one against the memory inside its window
(both ends included). Both kinds of test need only one earlier row:

* a *count* pattern fires when the (n-1)-th qualifying row before this one is inside the window;
* a *change* pattern fires when the latest row with another value is inside the window.

So no frame is ever buffered: the cost per row does not depend on how many rows share the window. Rows are taken in
(event time in ms, transaction_id) order, which also settles ties.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine import constants as C
from riskengine.functions.time import epoch
from riskengine.operators.slicing import OWN, ROWS_PER_SLICE, SLICE, WIDTH, halo_slices, with_widths

_KEYS = f"account_id, {SLICE}"
_ORDER = "_ms, transaction_id"


def _history() -> "Window":
    return Window.partitionBy("account_id", SLICE).orderBy("_ms", "transaction_id")


@dataclass(frozen=True)
class CountPattern:
    """Fires on a qualifying row that is at least the ``threshold``-th within ``window_s``."""

    name: str
    action: str
    qualifies: Callable[[], Column]
    window_s: int
    threshold: int = C.PATTERN_COUNT

    def mark(self, df: DataFrame, reached: Column, fired: str) -> DataFrame:
        time = f"{fired}_time"
        df = df.withColumn(time, F.when(reached & self.qualifies(), F.col("_ms")))
        if self.threshold <= 1:
            return df.withColumn(fired, F.col(time).isNotNull())
        nth = F.expr(
            f"lag({time}, {self.threshold - 1}) IGNORE NULLS OVER (PARTITION BY {_KEYS} ORDER BY {_ORDER})"
        )
        return df.withColumn(fired, F.coalesce(F.col(time) - nth <= self.window_s * 1000, F.lit(False)))


@dataclass(frozen=True)
class ChangePattern:
    """Fires on a row when another value of ``column`` was seen within ``window_s``."""

    name: str
    action: str
    column: str
    window_s: int

    def mark(self, df: DataFrame, reached: Column, fired: str) -> DataFrame:
        last = f"{fired}_last"
        before = _history().rowsBetween(Window.unboundedPreceding, -1)
        so_far = _history().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        seen = F.when(reached, F.struct(F.col("_ms").alias("ms"), F.col(self.column).alias("value")))
        df = df.withColumn(last, F.last(seen, ignorenulls=True).over(before))
        changed = reached & F.col(last).isNotNull() & ~F.col(f"{last}.value").eqNullSafe(F.col(self.column))
        other = F.last(F.when(changed, F.col(f"{last}.ms")), ignorenulls=True).over(so_far)
        within = reached & (F.col("_ms") - other <= self.window_s * 1000)
        return df.withColumn(fired, F.coalesce(within, F.lit(False)))


Pattern = CountPattern | ChangePattern


def _high_value() -> Column:
    return (F.col("amount") > C.HIGH_FREQUENCY_AMOUNT) & (F.col("status") == "Approved")


def _declined() -> Column:
    return F.lower("status") == "declined"


def _micropayment() -> Column:
    return F.col("amount").between(C.MICROPAYMENT_MIN, C.MICROPAYMENT_MAX)


LOCATION_JUMP = ChangePattern("LOCATION_JUMP", C.BLOCK, "location_name", C.LOCATION_JUMP_WINDOW_S)
HIGH_FREQUENCY = CountPattern("HIGH_FREQUENCY", C.BLOCK, _high_value, C.HIGH_FREQUENCY_WINDOW_S)
DECLINED_BURST = CountPattern("DECLINED_BURST", C.ALERT, _declined, C.DECLINED_BURST_WINDOW_S)
RAPID_MICROPAYMENTS = CountPattern("RAPID_MICROPAYMENTS", C.ALERT, _micropayment, C.MICROPAYMENT_WINDOW_S)


@dataclass(frozen=True)
class CepConfig:
    """Patterns in the order they are tried, and the slices the history is cut into.

    Accounts whose slices hold more rows than ``rows_per_slice`` are cut finer, at the cost of one pass that counts them;
    ``None`` leaves it out.
    """

    patterns: Sequence[Pattern] = field(
        default=(LOCATION_JUMP, HIGH_FREQUENCY, DECLINED_BURST, RAPID_MICROPAYMENTS)
    )
    slice_s: int = 86_400
    rows_per_slice: int | None = ROWS_PER_SLICE

    @property
    def lookback_s(self) -> int:
        """A pattern depends on what earlier patterns did inside its window, so the windows add up."""
        return sum(p.window_s for p in self.patterns)

    def with_windows(self, **seconds: int) -> "CepConfig":
        """Other window lengths by pattern name, e.g. ``DECLINED_BURST=1800``."""
        changed = [replace(p, window_s=seconds.get(p.name, p.window_s)) for p in self.patterns]
        return replace(self, patterns=tuple(changed))

    def with_thresholds(self, **counts: int) -> "CepConfig":
        changed = [replace(p, threshold=counts[p.name]) if p.name in counts else p for p in self.patterns]
        return replace(self, patterns=tuple(changed))

    @classmethod
    def from_properties(cls, props: dict[str, str]) -> "CepConfig":
        """Settings by key, each with its default."""

        def number(key: str, default: int) -> int:
            return int(props.get(f"cep.{key}", default))

        high = number("high-frequency.amount-min", C.HIGH_FREQUENCY_AMOUNT)
        low = number("rapid-micropayments.amount-min", C.MICROPAYMENT_MIN)
        top = number("rapid-micropayments.amount-max", C.MICROPAYMENT_MAX)
        return cls((
            replace(LOCATION_JUMP, window_s=number("location-jump.window.seconds", C.LOCATION_JUMP_WINDOW_S)),
            replace(
                HIGH_FREQUENCY,
                qualifies=lambda: (F.col("amount") > high) & (F.col("status") == "Approved"),
                window_s=number("high-frequency.window.seconds", C.HIGH_FREQUENCY_WINDOW_S),
                threshold=number("high-frequency.threshold", C.PATTERN_COUNT),
            ),
            replace(
                DECLINED_BURST,
                window_s=number("declined-burst.window.seconds", C.DECLINED_BURST_WINDOW_S),
                threshold=number("declined-burst.threshold", C.PATTERN_COUNT),
            ),
            replace(
                RAPID_MICROPAYMENTS,
                qualifies=lambda: F.col("amount").between(low, top),
                window_s=number("rapid-micropayments.window.seconds", C.MICROPAYMENT_WINDOW_S),
                threshold=number("rapid-micropayments.threshold", C.PATTERN_COUNT),
            ),
        ))


def sliced(df: DataFrame, config: CepConfig) -> DataFrame:
    timed, lookback = df.withColumn("_ms", epoch("event_time")), config.lookback_s * 1000
    timed = with_widths(timed, "_ms", config.slice_s * 1000, lookback, config.rows_per_slice)
    return halo_slices(timed, "_ms", lookback).drop(WIDTH)


def cascade(df: DataFrame, config: CepConfig, reaches: str, settled: str | None = None) -> DataFrame:
    """Adds ``cep_pattern`` to rows already cut by :func:`sliced`.

    A row that a pattern takes is not seen by the later ones. All steps share one partitioning and one order, so
    the plan has a single exchange and a single sort. Rows whose boolean column ``settled`` is true bring their
    ``cep_pattern`` and keep it.
    """
    columns = [c for c in df.columns if c != "cep_pattern"]
    reached, name = F.col(reaches), F.lit(None).cast("string")
    for i, pattern in enumerate(config.patterns):
        df = pattern.mark(df, reached, f"_hit{i}")
        hit = F.col(f"_hit{i}")
        if settled:
            stored = F.coalesce(F.col("cep_pattern") == pattern.name, F.lit(False))
            hit = F.when(F.col(settled), stored).otherwise(hit)
        reached = reached & ~hit
        name = F.coalesce(name, F.when(hit, pattern.name))
    return df.select(*columns, name.alias("cep_pattern"))


def cep_decide(
    df: DataFrame, config: CepConfig = CepConfig(), reaches: Column | None = None, settled: str | None = None
) -> DataFrame:
    """Adds ``cep_pattern``: the first pattern that fires, or null.

    ``reaches`` marks the rows that come to the patterns at all; others are neither tested nor remembered.
    """
    df = df.withColumn("_reaches", F.lit(True) if reaches is None else reaches)
    return cascade(sliced(df, config), config, "_reaches", settled).filter(OWN).drop("_reaches", "_ms", SLICE, OWN)


def pattern_alone(
    df: DataFrame, pattern: Pattern, slice_s: int = 86_400, fired: str = "fired", rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """One pattern by itself, as a boolean column."""
    config = CepConfig((pattern,), slice_s, rows_per_slice)
    cut = pattern.mark(sliced(df, config), F.lit(True), "_fired")
    return cut.filter(OWN).select(*df.columns, F.col("_fired").alias(fired))


def pattern_status(config: CepConfig) -> Column:
    """The action of the pattern in ``cep_pattern``."""
    status = F.lit(None).cast("string")
    for pattern in config.patterns:
        status = F.when(F.col("cep_pattern") == pattern.name, pattern.action).otherwise(status)
    return status


def location_jump(df: DataFrame, window_s: int = C.LOCATION_JUMP_WINDOW_S) -> DataFrame:
    return pattern_alone(df, replace(LOCATION_JUMP, window_s=window_s))


def high_frequency(df: DataFrame, window_s: int = C.HIGH_FREQUENCY_WINDOW_S) -> DataFrame:
    return pattern_alone(df, replace(HIGH_FREQUENCY, window_s=window_s))


def declined_burst(df: DataFrame, window_s: int = C.DECLINED_BURST_WINDOW_S) -> DataFrame:
    return pattern_alone(df, replace(DECLINED_BURST, window_s=window_s))


def rapid_micropayments(df: DataFrame, window_s: int = C.MICROPAYMENT_WINDOW_S) -> DataFrame:
    return pattern_alone(df, replace(RAPID_MICROPAYMENTS, window_s=window_s))


def windowed_count(df: DataFrame, qualifies: Callable[[], Column], threshold: int, window_s: int) -> DataFrame:
    """Any count pattern, for a user's own qualifier."""
    return pattern_alone(df, CountPattern("CUSTOM", C.ALERT, qualifies, window_s, threshold))
