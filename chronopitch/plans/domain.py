"""The reference domain read off the driver's tables, once as DataFrames and once as SQL with the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.session import table


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as matches of 20 teams; season labels turn in July; F is completed, O scheduled, P postponed."""
    o = table(spark, sf_dir, "orders")
    price = F.floor("o_totalprice").cast("bigint")
    home = F.pmod("o_custkey", F.lit(20))
    raw = F.pmod(F.floor(F.col("o_custkey") / 20), F.lit(19))
    kickoff = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(24)).cast("int"))).cast("timestamp_ntz")
    return o.select(
        F.col("o_orderkey").alias("fixture_id"), kickoff.alias("kickoff_at"), home.alias("home_team"), (raw + (raw >= home).cast("bigint")).alias("away_team"),
        F.pmod(price, F.lit(5)).alias("home_goals"), F.pmod(F.floor(price / 7), F.lit(4)).alias("away_goals"), N.season_label(N.season_start(kickoff)).alias("season"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "scheduled").otherwise("postponed").alias("status"),
        (F.pmod("o_orderkey", F.lit(7)) * 6).alias("delay_hours"), F.col("o_orderpriority").alias("competition"),
    )


MATCHES = """matches AS (
  SELECT fixture_id, kickoff_at, home_team, raw + CASE WHEN raw >= home_team THEN 1 ELSE 0 END AS away_team, home_goals, away_goals, status, delay_hours, competition,
         CAST(s AS VARCHAR) || '/' || lpad(CAST((s + 1) % 100 AS VARCHAR), 2, '0') AS season
  FROM (SELECT o_orderkey AS fixture_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS kickoff_at, o_custkey % 20 AS home_team, (o_custkey // 20) % 19 AS raw,
               CAST(floor(o_totalprice) AS BIGINT) % 5 AS home_goals, (CAST(floor(o_totalprice) AS BIGINT) // 7) % 4 AS away_goals,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE 'postponed' END AS status, (o_orderkey % 7) * 6 AS delay_hours, o_orderpriority AS competition,
               year(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) - CASE WHEN month(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))) < 7 THEN 1 ELSE 0 END AS s
        FROM orders))"""

#: Two rows a match.
TEAM_ROWS = """team_rows AS (
  SELECT fixture_id, kickoff_at, home_team AS team, TRUE AS is_home, home_goals AS gf, away_goals AS ga, season, status, delay_hours,
         CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END AS points FROM matches
  UNION ALL
  SELECT fixture_id, kickoff_at, away_team, FALSE, away_goals, home_goals, season, status, delay_hours, CASE WHEN away_goals > home_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END FROM matches)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a ledger: the user is the fixture, the type the capability; errors are failed attempts."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("entry_id"), F.col("user_id").alias("fixture_id"), F.col("event_type").alias("capability"), F.col("ts").alias("knowledge_at"), "value",
        F.when(F.col("event_type") == "error", "source_failed").otherwise("success").alias("state"), F.format_string("source-%d", F.pmod("event_id", F.lit(3))).alias("source"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


LEDGER = """ledger AS (
  SELECT event_id AS entry_id, user_id AS fixture_id, event_type AS capability, ts AS knowledge_at, value, CASE WHEN event_type = 'error' THEN 'source_failed' ELSE 'success' END AS state,
         'source-' || CAST(event_id % 3 AS VARCHAR) AS source, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""
