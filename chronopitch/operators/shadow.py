"""Shadow forecasts: eligibility, attestation, settlement with corrections, and track records that never mix populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def eligible(kickoff: Column, cutoff: Column, knowledge: Column, created: Column, persisted: Column, prediction_cutoff: Column, lineage: Column) -> Column:
    """Whether a forecast was truly made before its match, from what was known by then. lineage: times of its facts."""
    fine = (
        (knowledge <= cutoff) & (cutoff <= kickoff) & (knowledge <= created) & (created < kickoff) & (created <= persisted) & (persisted <= prediction_cutoff)
        & (prediction_cutoff < kickoff) & (prediction_cutoff >= F.greatest(cutoff, created, knowledge)) & (F.size(lineage) > 0) & ~F.exists(lineage, lambda t: t > cutoff)
    )
    return F.coalesce(fine, F.lit(False))


def attested(forecasts: DataFrame, persisted: Column) -> DataFrame:
    """Staged forecasts stamped when they were stored; only before kick-off."""
    stamped = forecasts.withColumn("persisted_at", persisted).withColumn("prediction_cutoff_at", F.greatest("cutoff_at", "created_at", "knowledge_at", "persisted_at"))
    return stamped.where(F.col("prediction_cutoff_at") < F.col("kickoff_at"))


def settlements(forecasts: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """A settlement per forecast and result known by now, each but the first correcting the one before it.

    forecasts: run_id, fixture_id; results: fixture_id, knowledge_at, result_id, home_goals, away_goals. A result that
    repeats the score before it is no correction. A fixture's results are few, whatever the table's size.
    """
    w = Window.partitionBy("fixture_id").orderBy("knowledge_at", "result_id")
    known = results.where(F.col("knowledge_at") <= now).withColumn("_b", F.lag(F.struct("home_goals", "away_goals")).over(w))
    changed = known.where(F.col("_b").isNull() | (F.col("_b") != F.struct("home_goals", "away_goals"))).drop("_b").withColumn("n", F.row_number().over(w))
    out = forecasts.select("run_id", "fixture_id").join(changed, "fixture_id")
    name = lambda n: F.concat_ws(":", F.lit("s"), F.col("run_id").cast("string"), n.cast("string"))
    return out.select("run_id", "fixture_id", name(F.col("n")).alias("settlement_id"), F.when(F.col("n") > 1, name(F.col("n") - 1)).alias("correction_of"), "home_goals", "away_goals", F.col("knowledge_at").alias("settled_at"))


def track_record(entries: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Means over entries that no correction replaces; a metric that is missing counts as 0."""
    gone = entries.where("correction_of IS NOT NULL").select(F.col("correction_of").alias("settlement_id")).distinct()
    live = entries.join(gone, "settlement_id", "left_anti")
    return live.groupBy(*by).agg(F.count("*").alias("sample_count"), *(F.avg(F.coalesce(m, F.lit(0.0))).alias(m) for m in metrics))


def evolution(runs: DataFrame, by: list[str]) -> DataFrame:
    """Each run with the change of its probabilities since the run before it. runs: created_at, run_id, p_home, p_draw, p_away."""
    w = Window.partitionBy(*by).orderBy("created_at", "run_id")
    return runs.select("run_id", *by, *((F.col(p) - F.lag(p).over(w)).alias(f"d_{p}") for p in ("p_home", "p_draw", "p_away")))


def projection(updates: DataFrame, key: str) -> DataFrame:
    """The live view of each fixture: latest status, a score that never goes back to none, the latest time anything was known.

    updates: updated_at, update_id, status, home_goals, away_goals, knowledge_at.
    """
    order = F.struct("updated_at", "update_id")
    scored = F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    return updates.groupBy(key).agg(
        F.max_by("status", order).alias("status"), F.max_by(F.struct("home_goals", "away_goals"), F.when(scored, order)).alias("_s"), F.max("knowledge_at").alias("knowledge_at"), F.max("updated_at").alias("updated_at"), F.count("*").alias("updates")
    ).select(key, "status", "_s.home_goals", "_s.away_goals", "knowledge_at", "updated_at", "updates")
