"""Training populations: snapshots with ratings, examples and skips, their manifest, and rule backtests over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronopitch.operators import population
from chronopitch.plans.domain import TEAM_ROWS, matches
from chronopitch.plans.model_queries import _ELO

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_SNAPSHOT = f"""{_ELO}, {TEAM_ROWS},
c AS (SELECT * FROM team_rows WHERE status = 'completed'),
p AS (SELECT t.fixture_id, t.team, h.fixture_id AS hf, h.kickoff_at AS hk, h.points, h.gf, h.ga, h.kickoff_at + INTERVAL 3 HOUR <= t.kickoff_at AS fine FROM c t JOIN c h ON h.team = t.team AND h.kickoff_at < t.kickoff_at),
b AS (SELECT fixture_id, team, count(*) AS blocked FROM p WHERE NOT fine GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY fixture_id, team ORDER BY hk DESC, hf DESC) AS k FROM p WHERE fine),
a AS (SELECT fixture_id, team, count(*) AS seen, avg(points) AS pts, avg(gf) AS gf, avg(ga) AS ga, max(hk) AS hk FROM r WHERE k <= 5 GROUP BY ALL),
u AS (SELECT m.competition, m.fixture_id, m.kickoff_at, m.home_team AS team, hb + d AS after FROM f JOIN matches m ON m.fixture_id = f.fixture_id WHERE n > 0 UNION ALL SELECT m.competition, m.fixture_id, m.kickoff_at, m.away_team, ab - d FROM f JOIN matches m ON m.fixture_id = f.fixture_id WHERE n > 0),
e AS (SELECT c.fixture_id, c.team, arg_max(u.after, struct_pack(a := u.kickoff_at, b := u.fixture_id)) AS rating FROM c JOIN matches m ON m.fixture_id = c.fixture_id JOIN u ON u.team = c.team AND u.competition = m.competition AND u.kickoff_at + INTERVAL 3 HOUR <= c.kickoff_at GROUP BY ALL),
s AS (SELECT c.fixture_id, c.is_home, c.season, c.kickoff_at, coalesce(a.seen, 0) AS seen, a.pts, a.gf, a.ga, (epoch_us(c.kickoff_at) - epoch_us(a.hk)) / 86400000000.0 AS rest, coalesce(b.blocked, 0) AS blocked, coalesce(e.rating, 1500.0) AS rating
      FROM c LEFT JOIN a ON a.fixture_id = c.fixture_id AND a.team = c.team LEFT JOIN b ON b.fixture_id = c.fixture_id AND b.team = c.team LEFT JOIN e ON e.fixture_id = c.fixture_id AND e.team = c.team),
w AS (SELECT h.fixture_id, h.season, h.kickoff_at, h.seen AS hs, g.seen AS gs, h.pts AS hp, g.pts AS gp, h.gf AS hg, g.gf AS gg, h.ga AS ha, g.ga AS gaa, h.rest AS hr, g.rest AS gr, h.rating AS he, g.rating AS ge, h.blocked AS hb, g.blocked AS gb FROM s h JOIN s g ON g.fixture_id = h.fixture_id AND h.is_home AND NOT g.is_home)"""
_REASONS = """concat_ws('+', CASE WHEN hs < 5 THEN 'insufficient_home_history' END, CASE WHEN gs < 5 THEN 'insufficient_away_history' END)"""


@query(f"""{_SNAPSHOT} SELECT fixture_id, hs AS home_matches_seen, gs AS away_matches_seen, round(hp, 6) AS home_points_avg, round(gp, 6) AS away_points_avg, round(hg, 6) AS home_goals_for_avg, round(gg, 6) AS away_goals_for_avg,
round(ha, 6) AS home_goals_against_avg, round(gaa, 6) AS away_goals_against_avg, round(hr, 6) AS home_rest_days, round(gr, 6) AS away_rest_days, round(he, 6) AS home_rating, round(ge, 6) AS away_rating, round(he - ge, 6) AS rating_difference,
CASE WHEN hb > 0 AND hs = 0 THEN 'pit_ineligible' ELSE 'observed' END AS home_seen_state, CASE WHEN hb > 0 AND hp IS NULL THEN 'pit_ineligible' WHEN hp IS NOT NULL THEN 'observed' ELSE 'missing' END AS home_points_state FROM w""")
def feature_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 B4 M15, 2.12 feature_snapshots: both sides' form, ratings as known at kick-off, and each feature's state."""
    out = population.snapshots(matches(spark, sf_dir))
    names = [f"{s}_{c}" for c in population.SIDE if c != "matches_seen" for s in ("home", "away")]
    state = lambda f: F.col("states")[f]
    return out.select("fixture_id", "home_matches_seen", "away_matches_seen", *(F.round(c, 6).alias(c) for c in (*names, "rating_difference")), state("home_matches_seen").alias("home_seen_state"), state("home_points_avg").alias("home_points_state"))


@query(f"""{_SNAPSHOT} SELECT fixture_id, season, {_REASONS} AS reasons FROM w""")
def training_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which completed matches are training examples, and why the others are not."""
    return population.population(matches(spark, sf_dir)).select("fixture_id", "season", "reasons")


@query(f"""{_SNAPSHOT} SELECT {_REASONS} AS reasons, count(*) AS n, min(kickoff_at) AS first_kickoff, max(kickoff_at) AS last_kickoff, count(DISTINCT season) AS seasons FROM w GROUP BY 1""")
def population_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population's counts, span and reasons."""
    return population.manifest(population.population(matches(spark, sf_dir)))


@query(f"""{_SNAPSHOT}, x AS (SELECT w.season, m.home_goals, m.away_goals, w.kickoff_at, w.fixture_id FROM w JOIN matches m ON m.fixture_id = w.fixture_id WHERE {_REASONS} = '' AND he - ge >= 20 AND hp >= gp),
y AS (SELECT *, CASE WHEN home_goals > away_goals THEN 1.0 ELSE -1.0 END AS unit FROM x)
SELECT season, count(*) AS bets, count(*) FILTER (WHERE unit > 0) AS won, round(sum(unit), 6) AS units, round(avg(unit), 6) AS roi FROM y GROUP BY season""")
def rule_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule over snapshots known before kick-off, settled at even stakes, by season."""
    rows = population.population(matches(spark, sf_dir)).where("reasons = '' AND rating_difference >= 20 AND home_points_avg >= away_points_avg")
    unit = F.when(F.col("home_goals") > F.col("away_goals"), 1.0).otherwise(-1.0)
    return rows.groupBy("season").agg(F.count("*").alias("bets"), F.count_if(unit > 0).alias("won"), F.round(F.sum(unit), 6).alias("units"), F.round(F.avg(unit), 6).alias("roi"))


@query(f"""{_SNAPSHOT}, g AS (SELECT fixture_id, season, he - ge AS edge, concat_ws('+', nullif({_REASONS}, ''), CASE WHEN abs(he - ge) < 5 THEN 'no_edge' END) AS withheld FROM w),
k AS (SELECT *, CASE WHEN withheld = '' THEN row_number() OVER (PARTITION BY season, withheld = '' ORDER BY abs(edge) DESC, fixture_id) END AS place FROM g)
SELECT fixture_id, CASE WHEN withheld <> '' THEN withheld WHEN place > 20 THEN 'over_cap' ELSE '' END AS withheld, CASE WHEN withheld = '' AND place <= 20 THEN place END AS place FROM k""")
def curation_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: hard gates with their reasons, then a cap of 20 a season by rank; what is withheld says why."""
    rows = population.population(matches(spark, sf_dir))
    edge = F.abs("rating_difference")
    rows = rows.withColumn("gate", F.concat_ws("+", F.nullif("reasons", F.lit("")), F.when(edge < 5, "no_edge")))
    place = F.row_number().over(Window.partitionBy("season", F.col("gate") == "").orderBy(F.desc(edge), "fixture_id"))
    rows = rows.withColumn("place", F.when(F.col("gate") == "", place).cast("bigint"))
    return rows.select("fixture_id", F.when(F.col("gate") != "", F.col("gate")).when(F.col("place") > 20, "over_cap").otherwise("").alias("withheld"), F.when((F.col("gate") == "") & (F.col("place") <= 20), F.col("place")).alias("place"))
