"""Late and out-of-order events: per-period counts by event time, corrected until a cut-off as late records arrive."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.operators.skew import buckets_of
from chronopitch.session import width

DAY = 86_400_000_000
ON_TIME, CORRECTS, DROPPED = "on_time", "corrects", "dropped"


def real_time(at: Column, known: Column) -> Column:
    """The time, or null where it plainly is none: before 1990, or more than a year after it was known."""
    fine = (at >= F.lit("1990-01-01").cast("timestamp")) & (known.isNull() | (at <= known + F.expr("INTERVAL 366 DAYS")))
    return F.when(fine & (at < F.lit("9000-01-01").cast("timestamp")), at)


#: Rows that one bucket holds at most about: a task's Arrow table, whatever the size of the data.
ROWS = 1_000_000
REFUSED = -1


class Replay:
    """One period's events in order of event time, with snapshots of their count at fixed steps.

    Events are taken in the order in which they become known. What is known by the period's end makes revision 0. A
    later event restores the snapshot before it, replays the sorted suffix up to the period's end and so replaces the
    outputs from its step on, earlier ones stand: each such restore is a revision. Past the cut-off the period is
    closed and refuses what comes.
    """

    def __init__(self, start: int, length: int, step: int, cutoff: int = 0) -> None:
        self.start, self.end, self.step, self.steps = start, start + length, step, max(1, -(-length // step))
        self.closed_at = self.end + cutoff
        self.times = np.zeros(0, np.int64)
        self.snapshots = np.zeros(self.steps + 1, np.int64)
        self.revision = 0

    def load(self, times: np.ndarray) -> int:
        """What arrived in time, at once; returns the total."""
        self.times = np.sort(times)
        self.snapshots = np.searchsorted(self.times, self.start + np.arange(self.steps + 1) * self.step)
        return int(self.snapshots[-1])

    def late(self, times: np.ndarray) -> tuple[int, int]:
        """Takes what arrived late together; returns the first step whose output changes and the new total."""
        first = int(max(0, (times.min() - self.start) // self.step))
        done = int(self.snapshots[first])  # the checkpoint: everything before it stays as it is
        suffix = np.sort(np.concatenate([self.times[done:], times]))
        self.times = np.concatenate([self.times[:done], suffix])
        ends = self.start + np.arange(first + 1, self.steps + 1) * self.step
        self.snapshots[first + 1 :] = done + np.searchsorted(suffix, ends)
        self.revision += 1
        return first, int(self.snapshots[-1])

    def run(self, times: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per event, in order of `known`: the revision it came in with (REFUSED if closed), its first step replaced, the total then."""
        revision, first, total = np.full(len(times), REFUSED, np.int64), np.zeros(len(times), np.int64), np.zeros(len(times), np.int64)
        on_time, open_ = np.searchsorted(known, [self.end, self.closed_at], side="left")
        revision[:on_time], total[:on_time] = self.revision, self.load(times[:on_time])
        # What becomes known within the same step makes one revision of the period.
        edges = [on_time, *(on_time + 1 + np.flatnonzero(np.diff(known[on_time:open_] // self.step))), open_] if open_ > on_time else []
        for a, b in zip(edges[:-1], edges[1:]):
            first[a:b], total[a:b] = self.late(times[a:b])
            revision[a:b] = self.revision
        total[open_:] = self.snapshots[-1]
        return revision, first, total


def _replay(period: int, cutoff: int, step: int):
    def run(rows: pa.Table) -> pa.Table:
        """The rows of a bucket of keys: with which revision of its period each distinct entry came in, and the total it made."""
        codes = [pc.dictionary_encode(rows["key"].cast(pa.large_string()).combine_chunks()).indices.to_numpy(zero_copy_only=False).astype(np.int64), rows["salt"].to_numpy()]
        key = np.unique(np.stack(codes), axis=1, return_inverse=True)[1].reshape(-1)
        at, known = rows["at"].to_numpy(), rows["known"].to_numpy()
        start = at // period * period
        revision, first, total = (np.zeros(len(rows), np.int64) for _ in range(3))
        order = np.lexsort((at, known, start, key))
        edges = np.flatnonzero(np.r_[True, (np.diff(key[order]) != 0) | (np.diff(start[order]) != 0), True]) if len(rows) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            own = order[a:b]
            revision[own], first[own], total[own] = Replay(int(start[own[0]]), period, step, cutoff).run(at[own], known[own])
        out = {"entry_id": rows["entry_id"], "key": rows["key"], "salt": rows["salt"], "period_start": pa.array(start)}
        return pa.table(out | {"known": rows["known"], "revision": pa.array(revision), "first_step": pa.array(first), "total": pa.array(total)})

    return run


def replayed(entries: DataFrame, key: list[str], hours: int = 48, period: int = DAY, step: int = DAY // 24, rows_a_bucket: int = ROWS) -> DataFrame:
    """Each distinct entry with its outcome: on_time, corrects or dropped, and what its arrival did to its period.

    entries: entry_id, source_observed_at, available_at, knowledge_at and the `key` columns. The event time is
    source_observed_at, or available_at where that is null or plainly no real time; entries with neither, or without
    knowledge_at, have none and are left out. A repeated entry counts once, as first known. The period is the UTC day
    of the event; it is first counted at its end, corrected by what becomes known less than `hours` later, and closed
    then. The outcome is what the replay did with the entry: revision 0 is on time, a later one corrects, refused is
    dropped; `total` is the period's (or its salt's) count after that revision. Buckets hold whole keys and days, about
    `rows_a_bucket` rows each; a day with more than a quarter of that is salted by entry, and the salts' totals add up
    (`counts`). Null key columns are a key of their own; empty tables give no rows.
    """
    spark = entries.sparkSession
    at = F.coalesce(real_time(F.col("source_observed_at"), F.col("knowledge_at")), real_time(F.col("available_at"), F.col("knowledge_at")))
    name = F.to_json(F.struct(*(F.col(k) for k in key)))
    rows = entries.where(F.col("knowledge_at").isNotNull() & F.col("entry_id").isNotNull())
    rows = rows.select("entry_id", name.alias("key"), F.unix_micros(at.cast("timestamp")).alias("at"), F.unix_micros(F.col("knowledge_at").cast("timestamp")).alias("known")).where(F.col("at").isNotNull())
    rows = rows.groupBy("entry_id").agg(F.min(F.struct("known", "at", "key")).alias("r")).select("entry_id", "r.*")
    day = F.expr(f"at div {period}")
    days = rows.groupBy("key", day.alias("day")).agg(F.count("*").alias("n"))
    buckets = buckets_of(days, "n", width(spark, 2), rows_a_bucket)
    # At most 4 days a bucket can hold more than a quarter of a bucket's share.
    hot = days.join(F.broadcast(buckets), F.col("n") > F.col("share")).select("key", "day", F.ceil(F.col("n") / F.col("share")).alias("salts"))
    rows = rows.withColumn("day", day).join(F.broadcast(hot), ["key", "day"], "left").join(F.broadcast(buckets))
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("entry_id"), F.col("salts")), F.lit(0)).cast("long"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "day", "salt"), F.col("buckets")))
    schema = "entry_id string, key string, salt long, period_start long, known long, revision long, first_step long, total long"
    done = rows.select("entry_id", "key", "salt", "at", "known", "bucket").groupBy("bucket").applyInArrow(_replay(period, hours * 3_600_000_000, step), schema)
    outcome = F.when(F.col("revision") == 0, ON_TIME).when(F.col("revision") > 0, CORRECTS).otherwise(DROPPED)
    return done.select("entry_id", "key", "salt", F.timestamp_micros("period_start").alias("period_start"), outcome.alias("outcome"), F.timestamp_micros("known").alias("known_at"), "revision", "first_step", "total")


def counts(done: DataFrame, key: list[str], types: list[str]) -> DataFrame:
    """Per key and period, off the replay's totals: what was first counted, what it was corrected to, how often and
    when last, and what was dropped. The totals of a period's salts add up."""
    in_time, kept = F.col("revision") == 0, F.col("revision") >= 0
    salt = done.groupBy("key", "period_start", "salt").agg(
        F.coalesce(F.max(F.when(in_time, F.col("total"))), F.lit(0)).alias("first_count"),
        F.coalesce(F.max(F.when(kept, F.col("total"))), F.lit(0)).alias("final_count"),
        F.count_if(~kept).alias("dropped"),
        F.max(F.when(kept & ~in_time, F.col("known_at"))).alias("corrected_at"),
        F.min(F.when(kept & ~in_time, F.col("first_step"))).alias("first_step_replaced"),
    )
    part = salt.groupBy("key", "period_start").agg(
        F.sum("first_count").alias("first_count"), F.sum("final_count").alias("final_count"), (F.sum("final_count") - F.sum("first_count")).alias("corrections"),
        F.sum("dropped").alias("dropped"), F.max("corrected_at").alias("corrected_at"), F.min("first_step_replaced").alias("first_step_replaced"),
    )
    parsed = F.from_json("key", ", ".join(f"{k} {t}" for k, t in zip(key, types)))
    return part.withColumn("_k", parsed).select(*(F.col(f"_k.{k}").alias(k) for k in key), *(c for c in part.columns if c != "key"))
