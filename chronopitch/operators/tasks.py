"""Observation tasks by horizon: their schedule, what is due, missed or superseded, and polling at a cadence."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.functions.normalize import HORIZONS
from chronopitch.operators.ordered import latest_by

RETRYABLE = ("missing", "source_failed")
LATE_S = 900


def schedule(fixtures: DataFrame, capabilities: list[str]) -> DataFrame:
    """The tasks of each fixture: every fixed horizon before kick-off, for every capability. fixtures: fixture_id, kickoff_at."""
    spots = F.array(*(F.struct(F.lit(h).alias("horizon"), F.lit(s).alias("offset")) for h, s in HORIZONS.items()))
    rows = fixtures.withColumn("h", F.explode(spots)).withColumn("capability", F.explode(F.array(*(F.lit(c) for c in capabilities))))
    at = (F.col("kickoff_at").cast("timestamp") - F.make_dt_interval(secs=F.col("h.offset"))).cast(dict(fixtures.dtypes)["kickoff_at"])
    return rows.select("fixture_id", "kickoff_at", F.col("h.horizon").alias("horizon"), "capability", at.alias("scheduled_for"))


#: Minutes before kick-off of each horizon, and the horizons that each capability is observed at.
OFFSETS = {"T-72h": 4320, "T-24h": 1440, "T-6h": 360, "T-1h": 60, "T-15m": 15}
_LATE = ("T-6h", "T-1h", "T-15m")
PLAN = {
    "fixture": tuple(OFFSETS), "lineups": ("T-1h", "T-15m"), "events": _LATE, "team_match_stats": _LATE, "shots": _LATE, "xgot": _LATE, "player_stats": _LATE,
    "xg": ("T-72h", "T-24h"), "xg_a": ("T-72h", "T-24h"),
}


def plan(fixtures: DataFrame) -> DataFrame:
    """All tasks of each fixture by PLAN, and one for its first observation: 27 in all. A task after kick-off is none.

    fixtures: fixture_id, kickoff_at, seen_at (null where it was never observed). Rows explode where they lie.
    """
    spots = [F.struct(F.lit(c).alias("capability"), F.lit(h).alias("horizon"), (F.col("kickoff_at").cast("timestamp") - F.make_dt_interval(mins=F.lit(OFFSETS[h]))).alias("scheduled_for")) for c, own in PLAN.items() for h in own]
    first = F.struct(F.lit("fixture").alias("capability"), F.lit("first_observed").alias("horizon"), F.col("seen_at").cast("timestamp").alias("scheduled_for"))
    rows = fixtures.select("fixture_id", "kickoff_at", F.explode(F.array(*spots, first)).alias("t")).select("fixture_id", "kickoff_at", "t.*")
    return rows.where(F.col("scheduled_for") <= F.col("kickoff_at").cast("timestamp"))


def task_state(scheduled: Column, now: Column, outcome: Column, late_s: int = LATE_S) -> Column:
    """pending, due within the lateness bound, missed_observation past it; a final outcome stays."""
    late = F.unix_micros(now.cast("timestamp")) - F.unix_micros(scheduled.cast("timestamp"))
    return F.when(outcome.isNotNull() & ~outcome.isin(*RETRYABLE), outcome).when(late < 0, "pending").when(late <= late_s * 1_000_000, "due").otherwise("missed_observation")


def superseded(tasks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Open or retryable tasks whose fixture's kick-off has moved since: tasks: task_id, fixture_id, kickoff_at, horizon,
    capability, created_at; outcomes: task_id, state, recorded_at."""
    last = latest_by(tasks.select("fixture_id", "horizon", "capability", F.col("kickoff_at").alias("current_kickoff"), "created_at", "task_id"), ["fixture_id", "horizon", "capability"], F.col("created_at"), F.col("task_id"))
    state = outcomes.groupBy("task_id").agg(F.max_by("state", F.struct("recorded_at", "state")).alias("state"))
    rows = tasks.join(last.drop("created_at", "task_id"), ["fixture_id", "horizon", "capability"]).join(state, "task_id", "left")
    return rows.where((F.col("kickoff_at") != F.col("current_kickoff")) & (F.col("horizon") != "fixture_first_observed") & (F.col("state").isNull() | F.col("state").isin(*RETRYABLE))).select("task_id", "fixture_id", "horizon")


def cadence(polls: DataFrame, every_s: int = 300) -> DataFrame:
    """The polls that are due: the first of a key, then each that is at least `every_s` after the last due one.

    polls: key, at, poll_id. A greedy fold, streamed in order per key with one number of state.
    """
    kind = dict(polls.dtypes)["poll_id"]
    rows = polls.select(F.col("key").cast("string").alias("key"), "poll_id", F.unix_micros(F.col("at").cast("timestamp")).alias("at"))
    rows = rows.repartition("key").sortWithinPartitions("key", "at", "poll_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = object(), 0
        for batch in batches:
            keep = []
            for key, when in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                due = key != last or when - at >= every_s * 1_000_000
                last, at = key, when if due else at
                keep.append(due)
            yield pa.RecordBatch.from_arrays([batch.column(1)], ["poll_id"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, f"poll_id {kind}")
