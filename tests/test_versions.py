"""Versioned tables and repeated appends."""

import threading

import pytest
from cohortlab.operators import access as X
from cohortlab.session import scratch_path
from cohortlab.sources.versions import Conflict, VersionedTable, append_batch, read_batches
from pyspark.sql import functions as F


def slots(spark, n=40):
    return spark.createDataFrame([(i, i % 7 == 0) for i in range(n)] + [(None, False)], "id long, is_booked boolean")


def requests(spark, rows):
    return spark.createDataFrame(rows, "id long, slot_id long, ts long")


@pytest.fixture
def table(spark):
    return VersionedTable.create(slots(spark), scratch_path(spark, "versioned"), "id", buckets=8)


def booked(table, version=None):
    return {r.id for r in table.read(version).where("is_booked").collect()}


def test_an_update_rewrites_only_its_buckets(spark, table):
    before = table._state(0)["folders"]
    version, out = X.book(table, requests(spark, [(1, 5, 10), (2, 5, 9), (3, 7, 1), (4, 99, 1), (5, None, 1)]))
    assert version == 1 and {r.id: r.outcome for r in out.collect()} == {
        1: "slot_taken", 2: "booked", 3: "already_booked", 4: "unknown_slot", 5: "unknown_slot"}
    after = table._state(1)["folders"]
    changed = {b for b in before if after[b] != before[b]}
    assert 1 <= len(changed) <= 3 and set(after) == set(before)
    assert booked(table) == booked(table, 0) | {5} and table.read().count() == table.read(0).count() == 41


def test_of_two_writers_one_wins_the_slot(spark, table):
    """Both read version 0; the second to publish works its update out again."""
    gate, outcomes = threading.Barrier(2), {}
    publish = VersionedTable._publish

    class Slow(VersionedTable):
        waited = False

        def _publish(self, version, state):
            if not self.waited:
                self.waited = True
                gate.wait(60)
            return publish(self, version, state)

    def run(k):
        outcomes[k] = [r.outcome for r in X.book(Slow(spark, table.path), requests(spark, [(k, 3, k), (10 + k, 20 + k, k)]))[1]
                       .orderBy("id").collect()]

    threads = [threading.Thread(target=run, args=(k,)) for k in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(o[0] for o in outcomes.values()) == ["already_booked", "booked"]
    assert all(o[1] in ("booked", "already_booked") for o in outcomes.values())
    assert table.latest() == 2 and booked(table) == booked(table, 0) | {3, 21, 22}


def test_a_writer_that_is_always_overtaken_gives_up(spark, table):
    def overtake(rows):
        table.update(rows.select("id"), lambda r: r)
        return rows

    with pytest.raises(Conflict):
        table.update(slots(spark, 3).where("id = 1"), overtake, attempts=2)
    with pytest.raises(Conflict):
        VersionedTable.create(slots(spark), table.path, "id")
    with pytest.raises(ValueError, match="keys"):
        table.update(slots(spark, 3).where("id = 1"), lambda r: r.withColumn("id", F.col("id") + 1))


def test_old_versions_are_dropped(spark, table):
    for k in (1, 2, 3):
        X.book(table, requests(spark, [(k, k, k)]))
    want = booked(table)
    table.drop_versions(table.latest())
    assert booked(table) == want and {1, 2, 3} <= want
    with pytest.raises(Exception, match="state.json"):
        table.read(0)


def test_batches_count_once(spark):
    path = scratch_path(spark, "batches")
    df = spark.range(10).withColumn("v", F.lit("x"))
    assert read_batches(spark, path, df.schema).count() == 0
    assert append_batch(df, path, "a") and not append_batch(df, path, "a")
    assert append_batch(df.limit(3), path, "b") and append_batch(df.limit(0), path, "none")

    def broken(batches):
        yield next(iter(batches))
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        append_batch(df.repartition(2).mapInArrow(broken, df.schema), path, "c")
    rows = read_batches(spark, path, df.schema)
    assert {r["batch"]: r["count"] for r in rows.groupBy("batch").count().collect()} == {"a": 10, "b": 3}
    assert append_batch(df, path, "c") and read_batches(spark, path, df.schema).count() == 23
    with pytest.raises(ValueError, match="name"):
        append_batch(df, path, "a/b")
