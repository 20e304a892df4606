"""Attributes as known at event time: the latest version recorded by each event's time, never a later one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.operators.skew import buckets_of, hot_bounds, piece
from chronopitch.session import width


def same_key(c: Column | str) -> Column:
    """A key as typed by people: blanks and letter case do not count."""
    return F.lower(F.regexp_replace(c, r"[\s ]+", ""))


def _latest(events: pa.Table, versions: pa.Table) -> pa.Table:
    """For each event the version of the same entity with the greatest time not after it, by one binary search.

    Both sides' entities are numbered alike; versions are ordered by entity, time and, last first, id, and each event
    is looked up to the right of all versions of its entity and time.
    """
    # Large strings: the texts of a bucket may pass what 32-bit offsets reach.
    keys = pa.chunked_array([*events["entity"].chunks, *versions["entity"].chunks], pa.string()).cast(pa.large_string()).combine_chunks()
    codes = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ours, theirs = codes[: len(events)], codes[len(events) :]
    at, known = events["at"].to_numpy(), versions["at"].to_numpy()
    rank = np.empty(len(versions), np.int64)
    rank[np.asarray(pc.sort_indices(versions["version_id"]))] = np.arange(len(versions))
    order = np.lexsort((-rank, known, theirs))
    # Times as ranks among both sides' times, so that entity and time make one number to search by.
    times = np.unique(np.concatenate([at, known]))
    line = theirs[order] * np.int64(len(times) + 1) + np.searchsorted(times, known[order])
    found = np.searchsorted(line, ours * np.int64(len(times) + 1) + np.searchsorted(times, at), side="right") - 1
    hit = (found >= 0) & (theirs[order][np.maximum(found, 0)] == ours) if len(versions) else np.zeros(len(events), bool)
    rows = order[found[hit]] if len(versions) else np.zeros(0, np.int64)
    return pa.table({"event_id": events["event_id"].filter(pa.array(hit)), "version_id": versions["version_id"].take(pa.array(rows)), "at": versions["at"].take(pa.array(rows))})


#: Rows that one bucket holds at most about: a task's Arrow tables, whatever the size of the data.
ROWS = 1_000_000


def as_known_at(events: DataFrame, versions: DataFrame, keep_unmatched: bool = False, rows_a_bucket: int = ROWS) -> DataFrame:
    """(event_id, version_id, known_at): for each event the version of its entity with the greatest known_at <= at.

    events: event_id string, entity string, at timestamp; versions: version_id string, entity string, known_at
    timestamp. Ties of known_at go to the smallest version_id. Events are co-grouped with versions by buckets of
    entities; an entity with more than its share of rows is cut by time into pieces, each of which is given the latest
    version of the pieces before. Null entities or times never match; repeated versions change nothing; repeated
    events are looked up each. Empty tables give no rows (events without a match come out only on request).
    """
    spark = events.sparkSession
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    e = events.where(F.col("entity").isNotNull() & F.col("at").isNotNull()).select("event_id", F.col("entity").alias("entity"), micros("at").alias("at"))
    v = versions.where(F.col("entity").isNotNull() & F.col("known_at").isNotNull() & F.col("version_id").isNotNull())
    v = v.select("version_id", F.col("entity").alias("entity"), micros("known_at").alias("at"))
    both = e.select("entity", "at").unionAll(v.select("entity", "at"))
    counted = both.groupBy("entity").agg(F.count("*").alias("_n"))
    buckets = buckets_of(counted, "_n", width(spark, 2), rows_a_bucket)
    bounds = hot_bounds(both, ["entity"], "at", buckets, counts=counted)
    cut = lambda df: df.join(F.broadcast(bounds), "entity", "left").withColumn("piece", piece(F.col("at"), F.col("bounds")))
    e, v = cut(e).drop("bounds"), cut(v)
    # The last version of each piece of a hot entity goes along into the pieces after it, up to the next that has one.
    last = v.where(F.col("bounds").isNotNull()).groupBy("entity", "piece").agg(F.min_by(F.struct("version_id", "at"), F.struct(-F.col("at"), F.col("version_id"))).alias("last"), F.first("bounds").alias("bounds"))
    ahead = last.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("piece", "last"))).alias("pieces"), F.first("bounds").alias("bounds"))
    ahead = ahead.select("entity", "pieces", F.explode(F.sequence(F.lit(1), F.greatest(F.size("bounds"), F.lit(1)))).alias("piece"))
    ahead = ahead.withColumn("before", F.expr("filter(pieces, p -> p.piece < piece)")).where(F.size("before") > 0)
    ahead = ahead.select(F.expr("element_at(before, -1).last.version_id").alias("version_id"), "entity", F.expr("element_at(before, -1).last.at").alias("at"), "piece")
    v = v.drop("bounds").unionByName(ahead)
    bucket = F.pmod(F.xxhash64("entity", "piece"), F.col("buckets")).alias("bucket")
    e, v = (df.join(F.broadcast(buckets)) for df in (e, v))
    got = (
        e.select("event_id", "entity", "at", bucket)
        .groupBy("bucket")
        .cogroup(v.select("version_id", "entity", "at", bucket).groupBy("bucket"))
        .applyInArrow(_latest, "event_id string, version_id string, at long")
    )
    got = got.select("event_id", "version_id", F.timestamp_micros("at").alias("known_at"))
    return events.select("event_id").join(got, "event_id", "left") if keep_unmatched else got
