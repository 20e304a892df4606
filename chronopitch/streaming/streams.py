"""Structured Streaming forms of the event-time operators; each, run to the end, leaves what its batch twin computes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopitch.operators.late import DAY, Replay, real_time
from chronopitch.session import cut


_LATE = "source string, capability string, day timestamp, first_count long, final_count long, corrections long, dropped long"
_OPEN = "times array<long>, snapshots array<long>, ids array<string>, first long, corrections long, dropped long"


def _replay(hours: int):
    """Folds a day's arrivals into its replay; the day's state goes when no correction can come any more."""
    cutoff = hours * 3_600_000_000

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        if state.hasTimedOut:
            state.remove()
            return
        source, capability, start = key
        day = Replay(int(start), DAY, DAY // 24, cutoff)
        ids: list = []
        first = corrections = dropped = 0
        if state.exists:
            times, snapshots, ids, first, corrections, dropped = state.get
            day.times, day.snapshots, ids = np.array(times, np.int64), np.array(snapshots, np.int64), list(ids)
        for rows in batches:
            rows = rows.sort_values(["known", "entry_id"]).drop_duplicates("entry_id")
            rows = rows[~rows["entry_id"].isin(ids)]
            at, known = rows["at"].to_numpy(np.int64), rows["known"].to_numpy(np.int64)
            a, b = np.searchsorted(known, [day.end, day.closed_at])
            for group in (at[:a], *np.split(at[a:b], np.flatnonzero(np.diff(known[a:b] // day.step)) + 1)):
                if len(group):
                    day.late(group)
            ids += rows["entry_id"].tolist()
            first, corrections, dropped = first + int(a), corrections + int(b - a), dropped + len(at) - int(b)
        closed = day.closed_at // 1000
        if state.getCurrentWatermarkMs() < closed:
            state.update((day.times.tolist(), day.snapshots.tolist(), ids, first, corrections, dropped))
            state.setTimeoutTimestamp(closed)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"source": [source], "capability": [capability], "day": [pd.Timestamp(int(start) * 1000)], "first_count": [first], "final_count": [int(day.snapshots[-1])], "corrections": [corrections], "dropped": [dropped]})

    return fold


def late_counts(entries: DataFrame, hours: int = 48, delay: str = "0 seconds") -> DataFrame:
    """Per source, capability and UTC day of the event: the day's replay as a stream, in update mode.

    entries: entry_id, source, capability, source_observed_at, available_at, knowledge_at (the arrival time, which the
    watermark follows with `delay`). A day's state is its sorted event times with snapshots and its entry ids; it is
    evicted when the watermark passes the day's end and `hours`. Each batch puts out the days it touched: a day's last
    row holds its counts, except that what comes for a day whose state is gone has a row of its own with only `dropped`.
    Null sources and capabilities are keys of their own; rows without an event time or an arrival time are left out.
    """
    known = F.col("knowledge_at").cast("timestamp")
    at = F.coalesce(real_time(F.col("source_observed_at"), known), real_time(F.col("available_at"), known)).cast("timestamp")
    rows = entries.select("entry_id", "source", "capability", known.alias("known_at"), F.unix_micros(at).alias("at"), F.unix_micros(known).alias("known")).where("at IS NOT NULL AND entry_id IS NOT NULL")
    rows = rows.withColumn("start", F.expr(f"at div {DAY} * {DAY}")).withWatermark("known_at", delay)
    return rows.groupBy("source", "capability", "start").applyInPandasWithState(_replay(hours), _LATE, _OPEN, "update", "EventTimeTimeout")


def due_and_missed(tasks: DataFrame, outcomes: DataFrame, late: str = "15 minutes") -> DataFrame:
    """Tasks joined with an outcome within the lateness bound, or missed: a stream-stream outer join by event time.

    tasks: task_id, scheduled_for; outcomes: o_task_id, recorded_at. A task without one comes out, as missed, when the
    watermark passes its bound.
    """
    t = tasks.select("task_id", F.col("scheduled_for").cast("timestamp").alias("scheduled_for")).withWatermark("scheduled_for", late)
    o = outcomes.select("o_task_id", F.col("recorded_at").cast("timestamp").alias("recorded_at")).withWatermark("recorded_at", late)
    on = (F.col("task_id") == F.col("o_task_id")) & (F.col("recorded_at") >= F.col("scheduled_for")) & (F.col("recorded_at") <= F.col("scheduled_for") + F.expr(f"INTERVAL {late}"))
    out = t.join(o, on, "left_outer")
    return out.select("task_id", "scheduled_for", "recorded_at", F.when(F.col("recorded_at").isNull(), "missed_observation").otherwise("success").alias("state"))


def health(signals: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Hourly attempts and failures per source and capability. signals: source, capability, attempted_at, success."""
    rows = signals.withColumn("attempted_at", F.col("attempted_at").cast("timestamp")).withWatermark("attempted_at", watermark)
    return rows.groupBy("source", "capability", F.window("attempted_at", "1 hour")).agg(F.count("*").alias("attempts"), F.count_if(~F.col("success")).alias("failures"))


_SCORE = "fixture_id string, status string, home_goals int, away_goals int, updated_at timestamp, updates long"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
    status, home, away, updated, n = state.get if state.exists else (None, None, None, None, 0)
    for rows in batches:
        for r in rows.sort_values(["updated_at", "update_id"]).itertuples(index=False):
            n += 1
            at = int(r.updated_at.value // 1000)
            if updated is None or at >= updated:
                status, updated = r.status, at
                if not (pd.isna(r.home_goals) or pd.isna(r.away_goals)):
                    home, away = int(r.home_goals), int(r.away_goals)
    state.update((status, home, away, updated, n))
    stamp = pd.Timestamp(updated * 1000) if updated is not None else pd.NaT
    yield pd.DataFrame({"fixture_id": [key[0]], "status": [status], "home_goals": pd.array([home], "Int32"), "away_goals": pd.array([away], "Int32"), "updated_at": [stamp], "updates": [n]})


def live_projection(updates: DataFrame) -> DataFrame:
    """Each fixture's live view as keyed state: the latest status, and a score that never goes back to none.

    updates: fixture_id, update_id, updated_at, status, home_goals, away_goals.
    """
    rows = updates.where("fixture_id IS NOT NULL AND updated_at IS NOT NULL").select("fixture_id", "update_id", F.col("updated_at").cast("timestamp").alias("updated_at"), "status", "home_goals", "away_goals")
    return rows.groupBy("fixture_id").applyInPandasWithState(_fold, _SCORE, "status string, home_goals int, away_goals int, updated long, n long", "update", "NoTimeout")


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update") -> None:
    """Runs a stream over what has landed so far and stops; `each` gets every micro-batch and must be idempotent."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def idempotent_append(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that a replay leaves unchanged: each batch is its own folder, overwritten whole, and rows
    whose key an earlier batch wrote are left out."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            before = spark.read.parquet(path).where(F.col("batch") < number).select(key)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            before = None  # nothing is there yet
        rows = batch.dropDuplicates([key])
        rows = rows if before is None else rows.join(before, key, "left_anti")
        cut(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
