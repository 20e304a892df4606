"""Append-only and upsert semantics over plain tables: what a write would leave, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.operators.ordered import latest_by

INSERTED, REPLAYED, CONFLICT = "inserted", "replayed", "conflict"


def row_hash(columns: list[str]) -> Column:
    """A row's content; nulls and blanks differ."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns)), 256)


def append_only(existing: DataFrame, incoming: DataFrame, key: str, content: list[str]) -> DataFrame:
    """What becomes of each distinct incoming row: inserted, replayed (known, alike) or conflict (known, different).

    Rows that come with two contents under one new key conflict as well. Only keys and hashes are shuffled.
    """
    new = incoming.select(key, row_hash(content).alias("h")).groupBy(key).agg(F.min("h").alias("h"), F.max("h").alias("h2"))
    old = existing.select(key, row_hash(content).alias("old")).groupBy(key).agg(F.min("old").alias("old"))
    both = new.join(old, key, "left")
    state = F.when((F.col("h") != F.col("h2")) | (F.col("old") != F.col("h")), CONFLICT).when(F.col("old").isNull(), INSERTED).otherwise(REPLAYED)
    return both.select(key, state.alias("write_state"))


def checked_append(existing: DataFrame, incoming: DataFrame, key: str, content: list[str]) -> DataFrame:
    """The new rows to append; a conflicting replay fails the job."""
    state = append_only(existing, incoming, key, content)
    fine = F.when(F.col("write_state") == CONFLICT, F.raise_error(F.concat(F.lit("conflicting replay of "), F.col(key).cast("string")))).otherwise(F.col("write_state") == INSERTED)
    return incoming.dropDuplicates([key]).join(state.where(fine), key, "left_semi")


def latest_wins(existing: DataFrame, incoming: DataFrame, key: str, updated: str) -> DataFrame:
    """The table after an upsert that never goes back in time; of equal times the incoming row wins."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return latest_by(both, [key], F.col(updated), F.col("_new"), row_hash(existing.columns)).drop("_new")


def coalesce_upsert(existing: DataFrame, incoming: DataFrame, key: str, sticky: list[str]) -> DataFrame:
    """The table after an upsert in which an incoming null never erases a sticky value; other columns are replaced."""
    old, new = existing.alias("o"), incoming.alias("n")
    both = old.join(new, key, "full")
    come = F.col(f"n.{[c for c in incoming.columns if c != key][0]}").isNotNull()
    for c in incoming.columns:
        if c not in (key, *sticky):
            come = come | F.col(f"n.{c}").isNotNull()
    pick = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) if c in sticky else F.when(come, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(key, *(pick(c).alias(c) for c in existing.columns if c != key))


def rank_of(source: Column, order: list[str]) -> Column:
    """A source's place in an order, one past the end for sources that are not in it."""
    return F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(s) for s in order)), source), F.lit(0)), F.lit(len(order) + 1))


def authority_update(current: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The table after updates that only a source of the same or a higher rank may make; unlisted sources update only their own."""
    best = latest_by(incoming, [key], -rank_of(F.col("source"), order), F.col("source"), row_hash(incoming.columns))
    both = current.alias("c").join(best.alias("i"), key, "full")
    may = F.col("c.source").isNull() | (F.col("c.source") == F.col("i.source")) | (F.col("i.source").isin(order) & (rank_of(F.col("i.source"), order) <= rank_of(F.col("c.source"), order)))
    take = F.col("i.source").isNotNull() & may
    return both.select(key, *(F.when(take, F.col(f"i.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in current.columns if c != key), take.alias("updated"))


def current_of_chain(rows: DataFrame, key: str, supersedes: str) -> DataFrame:
    """Rows that no other row supersedes."""
    return rows.join(rows.where(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(key)).distinct(), key, "left_anti")


def chain_violations(rows: DataFrame, key: str, supersedes: str, group: list[str]) -> DataFrame:
    """Per group what breaks its chain: a parent that is not there, two children of one parent, or more than one current row."""
    parent = rows.select(F.col(key).alias(supersedes), *(F.col(g).alias(f"_{g}") for g in group), F.lit(1).alias("_there")).distinct()
    linked = rows.where(F.col(supersedes).isNotNull()).join(parent, supersedes, "left")
    lost = linked.where(F.col("_there").isNull()).groupBy(*group).agg(F.count("*").alias("missing_parent"))
    forks = rows.where(F.col(supersedes).isNotNull()).groupBy(*group, supersedes).count().where("count > 1").groupBy(*group).agg(F.count("*").alias("forked"))
    several = current_of_chain(rows, key, supersedes).groupBy(*group).count().where("count > 1").select(*group, F.col("count").alias("several_current"))
    all_groups = rows.select(*group).distinct()
    out = all_groups.join(lost, group, "left").join(forks, group, "left").join(several, group, "left").na.fill(0)
    return out.where("missing_parent + forked + several_current > 0")


def evidence_store(rows: DataFrame, payload: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(payloads, manifests): each distinct payload once under its hash, and one manifest row per capture of it."""
    hashed = rows.withColumn("content_hash", F.sha2(F.col(payload).cast("string"), 256)).where(F.col(payload).isNotNull())
    payloads = hashed.groupBy("content_hash").agg(F.min(F.struct(*by)).alias("first_capture"), F.length(F.first(payload)).alias("size"), F.count("*").alias("captures"))
    manifests = hashed.select(*by, "content_hash", F.concat_ws("/", F.substring("content_hash", 1, 2), F.col("content_hash")).alias("object_path"))
    return payloads, manifests


def replay_checks(manifests: DataFrame, payloads: DataFrame) -> DataFrame:
    """Manifests whose payload is gone or has another hash. payloads: content_hash, payload."""
    found = payloads.select("content_hash", (F.sha2(F.col("payload").cast("string"), 256) == F.col("content_hash")).alias("sound"))
    return manifests.join(found, "content_hash", "left").where(~F.coalesce("sound", F.lit(False)))
