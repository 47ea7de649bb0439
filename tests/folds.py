"""Sequential twins of the window operators, one row at a time, to test against."""

from collections import defaultdict


def by_arrival(rows):
    return sorted(rows, key=lambda r: (r["account_id"], r["ms"], r["transaction_id"]))


def cep_fold(rows, windows, reaches=lambda r: True, n=3):
    """transaction_id -> pattern name or None; ``windows`` in seconds, by pattern name, in cascade order."""
    seen = defaultdict(list)
    qualifies = {
        "LOCATION_JUMP": lambda r: True,
        "HIGH_FREQUENCY": lambda r: r["amount"] > 100_000_000 and r["status"] == "Approved",
        "DECLINED_BURST": lambda r: r["status"].lower() == "declined",
        "RAPID_MICROPAYMENTS": lambda r: 2_000 <= r["amount"] <= 10_000,
    }
    out = {}
    for r in by_arrival(rows):
        hit = None
        if reaches(r):
            for name, seconds in windows.items():
                if not qualifies[name](r):
                    continue
                memory = seen[r["account_id"], name]
                memory.append((r["ms"], r["location_name"]))
                inside = [m for m in memory if r["ms"] - m[0] <= seconds * 1000]
                fires = len({m[1] for m in inside}) >= 2 if name == "LOCATION_JUMP" else len(inside) >= n
                if fires:
                    hit = name
                    break
        out[r["transaction_id"]] = hit
    return out
