"""State calls of the slot streams, stored margins of boosting, statistics of a forest's pass."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from cohortlab.ml import boosting as B
from cohortlab.ml import models as ML
from cohortlab.streaming import access, cooldown, jobs

DAY = 86_400_000_000


class Calls:
    """One key's state, counting what is asked of it."""

    def __init__(self):
        self.n, self.rows, self.value, self.timers = 0, {}, None, set()

    def getValueState(self, *_):
        return SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, clear=lambda: self.put(None), update=self.put)

    def getMapState(self, *_):
        return SimpleNamespace(containsKey=lambda k: self.count(k in self.rows), getValue=lambda k: self.count(self.rows[k]), keys=lambda: iter(list(self.rows)),
                               updateValue=lambda k, v: self.count(self.rows.update({k: v})), removeKey=lambda k: self.count(self.rows.pop(k)))

    def registerTimer(self, ms):
        self.count(self.timers.add(ms))

    def count(self, x):
        self.n += 1
        return x

    def put(self, v):
        self.value = self.count(v)


def plain(rows, gap):
    out, last = {}, {}
    for i, u, t in sorted(rows, key=lambda r: (r[2], r[0])):
        ok = u not in last or t >= last[u] + gap
        last[u] = t if ok else last.get(u)
        out[i] = int(ok)
    return out


def log(n, clients, days, seed=3):
    rng = random.Random(seed)
    return [(i, str(rng.randrange(clients)) if i % 50 else "", rng.randrange(days * DAY)) for i in range(n)]


@pytest.mark.parametrize("passed_days", [(8, 40), (3, 6, 40)])
def test_a_slot_of_many_clients_asks_its_state_once_a_chunk(passed_days):
    rows, state = log(2000, 400, 8), Calls()
    p = cooldown._Cooldown(3 * DAY, DAY)
    p.init(state)
    got, low = {}, 0
    for days in passed_days:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda at=low: at * DAY // 1000)
        new = [r for r in rows if low * DAY <= r[2] < days * DAY]
        assert list(p.handleInputRows((0,), iter([pd.DataFrame(new, columns=["id", "who", "t"])] if new else []), now)) == []
        low = days
        for out in p.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda at=days: at * DAY // 1000), None):
            got |= dict(zip(out["id"].tolist(), out["accepted"].tolist(), strict=True))
            assert out["user_id"].isna().sum() == sum(rows[i][1] == "" for i in out["id"])
    assert got == plain(rows, 3 * DAY)
    assert state.n < 100 and not state.rows and state.value is None  # 400 clients; before, three calls for each and chunk


def test_a_slot_of_the_plain_stream_decides_many_clients():
    rows, out, held = log(2000, 400, 8), [], SimpleNamespace(exists=False, hasTimedOut=False, until=[])

    def put(v):
        held.exists, held.get = True, v

    held.update, held.setTimeoutTimestamp = put, held.until.append
    held.remove = lambda: setattr(held, "exists", False)
    fn, low = jobs._cooldown_fn(3 * DAY), 0
    for days in (0, 4, 8, 40):
        held.getCurrentWatermarkMs = lambda at=low: at * DAY // 1000
        new = [r for r in rows if low * DAY <= r[2] < days * DAY]
        out += fn((0,), iter([pd.DataFrame(new, columns=["id", "who", "t"])] if new else []), held)
        low = days
    held.hasTimedOut, held.getCurrentWatermarkMs = True, lambda: 40 * DAY // 1000
    out += fn((0,), iter(()), held)
    got = {i: a for x in out for i, a in zip(x["id"].tolist(), x["accepted"].tolist(), strict=True)}
    assert got == plain(rows, 3 * DAY) and not held.exists


def test_names_of_the_access_state():
    assert access._parts("cool-down|0|a|b") == ("cool-down", 0, "a|b")


def test_slots_grow_with_the_log(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cooldown.slots_of(spark.range(10)) == 4 * width
    assert cooldown.slots_of(spark.range(100 * cooldown.ROWS_PER_SLOT + 1)) == 101


def test_margins_are_stored_often_where_there_are_several_tasks(spark, monkeypatch):
    df = spark.range(400).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "IF(id % 5 = 0, NULL, CAST(id % 23 AS DOUBLE)) AS b",
                                     "CAST(id % 17 > 8 OR id % 23 = 3 AS DOUBLE) AS y").repartition(3)
    one = B.fit_boosting(df, ["a", "b"], "y", B.BoostSpec(rounds=6, depth=2))
    seen, write = [], B.written_table
    monkeypatch.setattr(B, "written_table", lambda *a: seen.append(a) or write(*a))
    monkeypatch.setattr(B, "ROWS_PER_TASK", 100)
    several = B.fit_boosting(df, ["a", "b"], "y", B.BoostSpec(rounds=6, depth=2))
    assert len(seen) == 3
    assert np.allclose(one.losses, several.losses)
    assert all((s.feature == t.feature).all() and np.allclose(s.value, t.value) for s, t in zip(one.trees, several.trees, strict=True))


def test_bins_are_read_where_they_lie():
    a = pa.array([bytes([i, i + 1]) for i in range(9)], pa.binary())
    assert B._matrix(a.slice(3, 4), 2).tolist() == [[i, i + 1] for i in range(3, 7)]
    assert B._matrix(a.cast(pa.large_binary()).slice(8), 2).tolist() == [[8, 9]] and B._matrix(a.slice(9), 2).shape == (0, 2)


def test_a_forest_holds_statistics_that_fit_four_tasks(spark):
    from cohortlab.ml import preprocess as PP
    df = spark.range(60).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 2 AS DOUBLE) AS label")
    model = ML.fit_model(ML.ModelSpec("Random Forest", rf_trees=2, rf_depth=3), df, PP.fit_preprocessor(df, ["a"], []))
    assert model.stages[-1].getMaxMemoryInMB() <= 256
