"""The pattern processor's state calls: each is a round trip to the JVM per account and batch."""

import pandas as pd

from riskengine.operators.cep import CepConfig, ChangePattern
from riskengine.streaming.stateful import PatternProcessor, _steps


class _State:
    def __init__(self, calls, name):
        self.calls, self.name, self.value = calls, name, None

    def exists(self):
        self.calls.append((self.name, "exists"))
        return self.value is not None

    def get(self):
        self.calls.append((self.name, "get"))
        return self.value

    def update(self, value):
        self.calls.append((self.name, "update"))
        self.value = value

    def clear(self):
        self.calls.append((self.name, "clear"))
        self.value = None


class _Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema, ttl=None):
        return _State(self.calls, name)

    def registerTimer(self, at):
        self.calls.append(("timer", "register"))

    def deleteTimer(self, at):
        self.calls.append(("timer", "delete"))


def _batch(config, ms):
    rows = {"transaction_id": [str(m) for m in ms], "account_id": "A", "ms": ms}
    for i, p in enumerate(CepConfig().patterns):
        rows[f"t{i}"] = ["x"] * len(ms) if isinstance(p, ChangePattern) else [False] * len(ms)
    return pd.DataFrame(rows)


def test_one_read_per_state_and_batch():
    config = CepConfig()
    handle = _Handle()
    processor = PatternProcessor(_steps(config), keep_ms=60_000)
    processor.init(handle)
    for ms in ([1_000, 2_000], [3_000], [500]):
        list(processor.handleInputRows(("A",), iter([_batch(config, ms)]), None))
    assert ("patterns", "exists") not in handle.calls and ("expiry", "exists") not in handle.calls
    assert handle.calls.count(("patterns", "get")) == 3 and handle.calls.count(("expiry", "get")) == 3
    # The late batch moves no timer; the other two register one each and the second deletes the first.
    assert handle.calls.count(("timer", "register")) == 2 and handle.calls.count(("timer", "delete")) == 1
