"""Daily quantile sketches: accuracy, merging, and days stored once."""

import random

from cohortlab.operators import sketches as K
from cohortlab.session import scratch_path
from pyspark.sql import functions as F


def rank(values, q):
    return sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)


def test_sketches_merge_within_their_bound(spark):
    rng = random.Random(1)
    rows = [(d, g, rng.gauss(d, 3) if g else rng.random() ** 4) for d in range(12) for g in (0, 1) for _ in range(2000)]
    rows += [(3, 1, None), (3, 1, float("nan")), (50, 0, None)]
    df = spark.createDataFrame(rows, "d int, g int, v double").repartition(6)
    days = K.daily_sketches(df, F.col("d"), ["g"], "v").cache()
    assert days.count() == 24 and {r["rows"] for r in days.collect()} == {2000}
    for lo, hi in ((0, 11), (4, 6)):
        found = K.quantiles(K.merged(days.where(f"day between {lo} and {hi}"), ["g"]), ["g"], [0.01, 0.5, 0.9]).collect()
        assert len(found) == 6
        for r in found:
            values = [v for d, g, v in rows if lo <= d <= hi and g == r["g"] and v == v and v is not None]
            below, upto = rank(values, r["q"])
            assert r["rows"] == len(values) and below - 0.02 <= r["p"] <= upto + 0.02


def test_days_are_stored_once_and_small_days_are_exact(spark):
    df = spark.createDataFrame([(1, float(i)) for i in range(101)], "d int, v double")
    day = K.daily_sketches(df, F.col("d"), [], "v").cache()
    path = scratch_path(spark, "sketch_days")
    assert K.store_day(day, path, "1") and not K.store_day(day, path, "1")
    held = K.stored(spark, path, day.schema)
    got = K.quantiles(held, ["day"], [0.0, 0.5, 1.0]).orderBy("p").collect()
    assert [r["q"] for r in got] == [0.0, 50.0, 100.0] and got[0]["rows"] == 101
    assert K.daily_sketches(df.limit(0), F.col("d"), [], "v").count() == 0
