"""Populations for training: feature snapshots with ratings, examples and skipped fixtures with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.operators import asof, pit, ratings

#: What a snapshot holds of each side.
SIDE = ("matches_seen", "points_avg", "goals_for_avg", "goals_against_avg", "rest_days", "rating")
HISTORY = 5


def ratings_as_known(sides: DataFrame, matches: DataFrame, safety: str = pit.SAFETY) -> DataFrame:
    """(fixture_id, team, rating): each side's rating by what was eligible at its cut-off, 1500 where nothing was.

    sides: fixture_id, competition, team, kickoff_at; matches as `ratings.elo` takes them. A match counts `safety` after
    its kick-off. Ratings are folded once per competition; each side then reads them as known at its kick-off.
    """
    entity = F.concat_ws("\x1f", F.col("competition").cast("string"), F.col("team").cast("string"))
    told = ratings.history(ratings.elo(matches), matches).join(matches.select("fixture_id", "competition"), "fixture_id")
    # Of matches at one time the last in the fold's order holds; ties go to the smallest id, so ids count down.
    told = told.select(F.format_string("%020d", F.lit(10**18) - F.col("fixture_id").cast("long")).alias("version"), entity.alias("entity"), (F.col("kickoff_at").cast("timestamp") + F.expr(safety)).alias("known_at"), "rating_after")
    asked = sides.select("fixture_id", "team", F.concat_ws("\x1f", F.col("fixture_id").cast("string"), F.col("team").cast("string")).alias("event_id"), entity.alias("entity"), F.col("kickoff_at").cast("timestamp").alias("at"))
    versions = told.select(F.concat_ws("\x1f", "version", "entity").alias("version_id"), "entity", "known_at")
    found = asof.as_known_at(asked.select("event_id", "entity", "at"), versions)
    found = found.join(told.select(F.concat_ws("\x1f", "version", "entity").alias("version_id"), "rating_after"), "version_id").select("event_id", "rating_after")
    return asked.join(found, "event_id", "left").select("fixture_id", "team", F.coalesce("rating_after", F.lit(ratings.BASE)).alias("rating"))


def snapshots(matches: DataFrame, n: int = HISTORY, safety: str = pit.SAFETY) -> DataFrame:
    """A row per completed match: both sides' form over the last n eligible matches, ratings, blocked history, and per
    feature its state (observed, missing or pit_ineligible) in `states`.

    matches: fixture_id, competition, kickoff_at, home_team, away_team, home_goals, away_goals, season, status.
    """
    done = matches.where("status = 'completed' AND home_goals IS NOT NULL AND away_goals IS NOT NULL")
    rows = pit.team_rows(done, "competition")
    history = rows.withColumn("eligible_at", (F.col("kickoff_at").cast("timestamp") + F.expr(safety)).cast(dict(matches.dtypes)["kickoff_at"]))
    form = pit.form_as_known(rows.withColumn("cutoff_at", F.col("kickoff_at")), history, n)
    form = form.join(ratings_as_known(rows, done, safety), ["fixture_id", "team"])
    side = form.join(rows.select("fixture_id", "team", "is_home"), ["fixture_id", "team"])
    pick = [F.max(F.when(F.col("is_home") == home, F.col(c))).alias(f"{name}_{c}") for name, home in (("home", True), ("away", False)) for c in (*SIDE, "blocked")]
    wide = side.groupBy("fixture_id").agg(*pick)
    wide = wide.withColumn("rating_difference", F.col("home_rating") - F.col("away_rating"))
    states = [F.struct(F.lit(f"{s}_{c}").alias("feature"), pit.missingness(F.col(f"{s}_{c}"), F.col(f"{s}_blocked") > 0, counts=c == "matches_seen").alias("state")) for s in ("home", "away") for c in SIDE]
    wide = wide.withColumn("states", F.map_from_entries(F.array(*states)))
    return done.select("fixture_id", "season", "kickoff_at", "home_goals", "away_goals").join(wide, "fixture_id")


def skip_reasons(min_history: int = HISTORY) -> Column:
    """Why a snapshot is no training example, joined by +; an empty text if it is one."""
    few = F.array_compact(F.array(*(F.when(F.coalesce(F.col(f"{s}_matches_seen"), F.lit(0)) < min_history, F.lit(f"insufficient_{s}_history")) for s in ("home", "away"))))
    barred = F.exists(F.map_values("states"), lambda s: s == "pit_ineligible")
    return F.concat_ws("+", F.when((F.size(few) == 0) & barred, F.array(F.lit("pit_ineligible_feature"))).otherwise(few))


def population(matches: DataFrame, min_history: int = HISTORY) -> DataFrame:
    """The snapshots with `reasons`: training examples have none, skipped fixtures say why."""
    return snapshots(matches).withColumn("reasons", skip_reasons(min_history))


def manifest(rows: DataFrame) -> DataFrame:
    """Per reason (none for examples): how many, from when to when, over how many seasons."""
    return rows.groupBy("reasons").agg(F.count("*").alias("n"), F.min("kickoff_at").alias("first_kickoff"), F.max("kickoff_at").alias("last_kickoff"), F.count_distinct("season").alias("seasons"))
