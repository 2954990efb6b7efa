from __future__ import annotations

import random
from datetime import date, timedelta

from civicloom.operators.intervals import periods_and_gaps

SCHEMA = "p string, r string, s date, e date, kind string"


def brute(rows):
    out = set()
    groups = {}
    for p, r, s, e, _ in rows:
        e = e or date(9999, 12, 31)
        if s and e >= s:
            groups.setdefault((p, r), []).append((s.toordinal(), e.toordinal()))
    for key, spans in groups.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        day = lambda n: date.fromordinal(n).isoformat()
        out |= {(*key, "period", day(a), day(b)) for a, b in merged}
        out |= {(*key, "gap", day(x[1] + 1), day(y[0] - 1)) for x, y in zip(merged, merged[1:])}
    return out


def test_against_brute_force_for_every_shard_width(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        s = date(1960, 1, 1) + timedelta(days=rng.randrange(9000))
        e = rng.choice([None, s + timedelta(days=rng.randrange(-20, 900)), s])
        rows.append((rng.choice(["a", "b", "c", None]), rng.choice(["m", "M", None]), rng.choice([s, s, s, None]), e if rng.random() < 0.95 else None, "x"))
    rows += rows[:40]
    rows += [("hot", "m", date(1970, 1, 1) + timedelta(days=2 * i), date(1970, 1, 1) + timedelta(days=2 * i), "x") for i in range(500)]
    rows += [("old", "m", date(1500, 1, 1), date(1500, 1, 3), "x"), ("old", "m", date(1500, 1, 4), date(2300, 1, 1), "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    for width in (7, 366, 4096):
        got = {tuple(r) for r in periods_and_gaps(df, ["p", "r"], "s", "e", width).collect()}
        assert got == brute(rows)


def test_empty(spark):
    assert periods_and_gaps(spark.createDataFrame([], SCHEMA), ["p", "r"], "s", "e").count() == 0
