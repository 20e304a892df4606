import random
from datetime import datetime, timedelta

import numpy as np

from chronopitch.operators import late

SCHEMA = "entry_id string, source string, capability string, source_observed_at timestamp, available_at timestamp, knowledge_at timestamp, salt string, at string"


def test_replay_equals_a_recount():
    rng = np.random.default_rng(3)
    state = late.Replay(0, 86_400, 3_600)
    have = rng.integers(0, 86_400, 200)
    state.load(have)
    for _ in range(40):
        more = rng.integers(0, 86_400, rng.integers(1, 5))
        first, total = state.late(more)
        have = np.sort(np.concatenate([have, more]))
        assert total == len(have) and first == more.min() // 3_600
        assert (state.times == have).all() and (state.snapshots == np.searchsorted(have, np.arange(25) * 3_600)).all()


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_outcomes_against_brute_force(spark):
    random.seed(5)
    day = datetime(2024, 3, 1)
    rows, expected = [], {}
    for i in range(600):
        # A third of all rows on one key and day.
        at = day + timedelta(seconds=random.randrange(86_400)) if i % 3 == 0 else day + timedelta(days=random.randrange(9), seconds=random.randrange(86_400))
        known = at + timedelta(hours=random.choice([0, 1, 20, 30, 60, 100]), seconds=random.randrange(3_600))
        rows.append((f"e{i}", "s" if i % 3 == 0 else f"s{i % 4}", None if i % 50 == 0 else "c", at, at, known))
        end = datetime(at.year, at.month, at.day) + timedelta(days=1)
        expected[f"e{i}"] = "on_time" if known < end else "corrects" if known < end + timedelta(hours=48) else "dropped"
    done = late.replayed(rows_of(spark, rows + rows[:100]), ["source", "capability"])
    assert {r["entry_id"]: r["outcome"] for r in done.collect()} == expected
    totals = late.counts(done, ["source", "capability"], ["string", "string"]).collect()
    assert sum(r["final_count"] + r["dropped"] for r in totals) == 600
    assert all(r["final_count"] == r["first_count"] + r["corrections"] for r in totals)


def test_times_that_are_none(spark):
    known, fine = datetime(2024, 3, 5), datetime(2024, 3, 1)
    rows = [
        ("both", "s", "c", None, None, known), ("stand-in", "s", "c", datetime(1970, 1, 1), fine, known), ("far", "s", "c", datetime(9999, 12, 31), None, known),
        ("edge", "s", "c", fine, None, datetime(2024, 3, 2)), ("cut-off", "s", "c", fine, None, datetime(2024, 3, 4)), ("never", "s", "c", fine, fine, None), (None, "s", "c", fine, fine, known),
    ]
    got = {r["entry_id"]: r["outcome"] for r in late.replayed(rows_of(spark, rows), ["source", "capability"]).collect()}
    assert got == {"stand-in": "dropped", "edge": "corrects", "cut-off": "dropped"}
    assert late.replayed(rows_of(spark, rows).limit(0), ["source", "capability"]).count() == 0


def test_the_counts_come_from_the_replay(spark, monkeypatch):
    """A replay that goes wrong shows: the counts are its totals, the outcomes its revisions."""
    day = datetime(2024, 3, 1)
    rows = [(f"e{i}", "s", "c", day, day, day + timedelta(hours=h)) for i, h in enumerate([1, 2, 30, 40, 100])]
    read = lambda run: {(r["first_count"], r["final_count"], r["corrections"], r["dropped"]) for r in late.counts(run, ["source", "capability"], ["string", "string"]).collect()}
    whole = late.replayed(rows_of(spark, rows), ["source", "capability"])
    assert read(whole) == {(2, 4, 2, 1)}

    class Forgetful(late.Replay):
        def late(self, times):
            first, total = super().late(times)
            return first, total - 1

    monkeypatch.setattr(late, "Replay", Forgetful)
    assert read(late.replayed(rows_of(spark, rows), ["source", "capability"])) != {(2, 4, 2, 1)}


def test_small_buckets_and_salted_days_give_the_same(spark):
    random.seed(8)
    day = datetime(2024, 3, 1)
    rows = [(f"e{i}", f"s{i % 5 % 2}", "c", day + timedelta(seconds=random.randrange(200_000)), None, day + timedelta(hours=random.randrange(150))) for i in range(900)]
    key = ["source", "capability"]
    few, many = (late.replayed(rows_of(spark, rows), key, rows_a_bucket=n) for n in (10**6, 20))
    assert {(r["entry_id"], r["outcome"]) for r in few.collect()} == {(r["entry_id"], r["outcome"]) for r in many.collect()}
    assert sorted(map(tuple, late.counts(few, key, ["string"] * 2).collect())) == sorted(map(tuple, late.counts(many, key, ["string"] * 2).collect()))
    assert many.agg({"salt": "max"}).head()[0] > 0
