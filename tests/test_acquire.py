from datetime import datetime

from pyspark.sql import functions as F

from chronopitch.operators import acquire, health, reconcile, tasks


def test_a_fixture_has_27_tasks(spark):
    kick = datetime(2024, 5, 4, 15)
    rows = [("a", kick, datetime(2024, 4, 1)), ("b", kick, datetime(2024, 5, 4, 16)), ("c", kick, None), ("d", None, kick)]
    got = tasks.plan(spark.createDataFrame(rows, "fixture_id string, kickoff_at timestamp, seen_at timestamp"))
    assert {r["fixture_id"]: r["count"] for r in got.groupBy("fixture_id").count().collect()} == {"a": 27, "b": 26, "c": 26}
    assert got.where("horizon = 'first_observed'").count() == 1


def test_leases(spark):
    claims = spark.createDataFrame([("r", 1, 0, 1), ("r", 2, 5, 2), ("r", 1, 9, 3), ("r", 2, 19, 4), ("s", 2, 1, 5)], "resource string, token int, at long, event_id long")
    got = {r["event_id"]: (r["holder"], r["until"], r["granted"]) for r in acquire.leases(claims, 10).collect()}
    assert got == {1: (1, 10, True), 2: (1, 10, False), 3: (1, 19, True), 4: (2, 29, True), 5: (2, 11, True)}
    assert acquire.leases(claims.limit(0), 10).count() == 0


def test_quarantine_ids_are_those_of_a_replay(spark):
    rows = spark.createDataFrame([("e1", None, 3), ("e2", "p", None)], "id string, payload string, code int")
    run = lambda: sorted(map(tuple, acquire.quarantine(rows.drop("code"), {"none": F.col("payload").isNull(), "odd": F.lit(None).cast("boolean")}, ["id", "payload"]).collect()))
    assert run() == run() and len(run()) == 1 and run()[0][0] == "e1"


def test_failures_before_the_serving_source(spark):
    rows = [("k", "a", False), ("k", "a", False), ("k", "b", True), ("k", "c", False), ("none", "a", False), ("none", "b", False)]
    got = health.first_supported(spark.createDataFrame(rows, "key string, source string, ok boolean"), ["key"], F.col("source"), F.col("ok"))
    assert {tuple(r) for r in got.collect()} == {("k", "b", 4, 2), ("none", None, 2, 2)}


def test_conflicts_tell_nulls_from_values(spark):
    rows = [(1, "a", 1.0), (1, "a", None), (2, None, None), (2, None, None), (3, "x", 1.0), (3, "y", 1.0), (4, None, 2.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double")
    assert {tuple(map(str, r)) for r in reconcile.conflicts(df, ["k"], ["s", "v"]).collect()} == {("1", "2", "['v']"), ("3", "2", "['s']")}
    assert reconcile.conflicts(df.limit(0), ["k"], ["s"]).count() == 0
