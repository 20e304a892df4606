import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chronopitch.operators import asof, ordered
from chronopitch.operators.skew import hot_bounds


def at(n):
    return datetime(2024, 1, 1) + timedelta(seconds=n)


def frames(spark, events, versions):
    e = spark.createDataFrame(events, "event_id string, entity string, at timestamp, bucket int")
    v = spark.createDataFrame(versions, "version_id string, entity string, known_at timestamp, piece int")
    return e, v


def test_against_brute_force_with_a_hot_entity_and_ties(spark):
    random.seed(1)
    name = lambda: "hot" if random.random() < 0.4 else f"k{random.randrange(30)}"
    events = [(f"e{i}", name(), at(random.randrange(500)), 1) for i in range(800)]
    versions = [(f"v{i}", name(), at(random.randrange(500)), 1) for i in range(900)]
    versions += versions[:50]
    expected = {}
    for e, k, t, _ in events:
        known = [(kt, v) for v, vk, kt, _ in versions if vk == k and kt <= t]
        if known:
            latest = max(kt for kt, _ in known)
            expected[e] = min(v for kt, v in known if kt == latest)
    e, v = frames(spark, events, versions)
    assert hot_bounds(e.select("entity", F.unix_micros("at").alias("t")), ["entity"], "t", 8).count() >= 1
    assert {r["event_id"]: r["version_id"] for r in asof.as_known_at(e, v).collect()} == expected


def test_nothing_later_and_nothing_null(spark):
    e, v = frames(spark, [("e", "k", at(5), 1), ("n", None, at(5), 1), ("t", "k", None, 1), ("x", "other", at(9), 1)], [("late", "k", at(6), 1), (None, "k", at(1), 1), ("null", "k", None, 1)])
    assert asof.as_known_at(e, v).count() == 0
    assert {r["event_id"] for r in asof.as_known_at(e, v, keep_unmatched=True).collect()} == {"e", "n", "t", "x"}
    assert asof.as_known_at(e, v.limit(0)).count() == 0 and asof.as_known_at(e.limit(0), v).count() == 0


def test_keys_as_typed(spark):
    got = spark.createDataFrame([(" A:1 ",), ("a:1",), ("a :1",)], "k string").select(asof.same_key("k")).distinct().collect()
    assert [r[0] for r in got] == ["a:1"]


def test_frames_over_pieces_equal_plain_windows(spark):
    random.seed(2)
    rows = spark.createDataFrame([(("hot" if random.random() < 0.5 else f"k{i % 9}"), random.randrange(60), i, float(i % 7)) for i in range(900)], "k string, o long, i long, v double")
    rows = rows.cache()
    got = ordered.with_last(rows, ["k"], "o", "i", 5, {"m": F.avg("v"), "n": F.count(F.lit(1))})
    plain = rows.selectExpr("*", "avg(v) OVER w m", "count(1) OVER w n") if False else spark.sql("SELECT *, avg(v) OVER (PARTITION BY k ORDER BY o, i ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) m, count(1) OVER (PARTITION BY k ORDER BY o, i ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) n FROM {r}", r=rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    sums = ordered.with_running(rows, ["k"], "o", {"s": F.lit(1).cast("long")})
    again = spark.sql("SELECT *, coalesce(count(1) OVER (PARTITION BY k ORDER BY o RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) s FROM {r}", r=rows)
    assert sorted(map(str, sums.collect())) == sorted(map(str, again.collect()))
