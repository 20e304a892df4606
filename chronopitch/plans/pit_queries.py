"""Point-in-time queries: forms, eligibility, as-of reads, missingness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.operators import asof, ordered, pit
from chronopitch.plans.domain import LEDGER, MATCHES, TEAM_ROWS, ledger, matches
from chronopitch.session import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


_FORM = "count(*) OVER w AS matches_seen, avg(points) OVER w AS points_avg, avg(gf) OVER w AS goals_for_avg, avg(ga) OVER w AS goals_against_avg"
_LAST5 = "w AS (PARTITION BY team ORDER BY kickoff_at, fixture_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


@query(f"""
WITH {MATCHES}, {TEAM_ROWS},
f AS (SELECT fixture_id, kickoff_at, is_home, {_FORM}, epoch_us(kickoff_at) - epoch_us(lag(kickoff_at) OVER (PARTITION BY team ORDER BY kickoff_at, fixture_id)) AS gap FROM team_rows WINDOW {_LAST5})
SELECT fixture_id, kickoff_at, max(CASE WHEN is_home THEN matches_seen END) AS home_matches_seen, round(max(CASE WHEN is_home THEN points_avg END), 6) AS home_points_avg,
  round(max(CASE WHEN is_home THEN goals_for_avg END), 6) AS home_goals_for_avg, round(max(CASE WHEN is_home THEN goals_against_avg END), 6) AS home_goals_against_avg,
  round(max(CASE WHEN is_home THEN gap / 86400000000.0 END), 6) AS home_rest_days, max(CASE WHEN NOT is_home THEN matches_seen END) AS away_matches_seen,
  round(max(CASE WHEN NOT is_home THEN points_avg END), 6) AS away_points_avg, round(max(CASE WHEN NOT is_home THEN goals_for_avg END), 6) AS away_goals_for_avg,
  round(max(CASE WHEN NOT is_home THEN goals_against_avg END), 6) AS away_goals_against_avg, round(max(CASE WHEN NOT is_home THEN gap / 86400000000.0 END), 6) AS away_rest_days
FROM f GROUP BY fixture_id, kickoff_at""")
def pit_form_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides' last five matches before each match."""
    out = pit.snapshot(matches(spark, sf_dir))
    return _rounded(out, *(f"{s}_{c}" for s in ("home", "away") for c in ("points_avg", "goals_for_avg", "goals_against_avg", "rest_days")))


@query(f"""
WITH {MATCHES}, {TEAM_ROWS}
SELECT fixture_id, team, is_home, count(*) OVER w AS matches_seen, round(avg(gf) OVER w, 6) AS goals_for_avg, round(avg(ga) OVER w, 6) AS goals_against_avg
FROM team_rows WINDOW w AS (PARTITION BY team, is_home ORDER BY kickoff_at, fixture_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def venue_form_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five at home, or away."""
    out = pit.form(matches(spark, sf_dir), venue=True).select("fixture_id", "team", "is_home", "matches_seen", "goals_for_avg", "goals_against_avg")
    return _rounded(out, "goals_for_avg", "goals_against_avg")


def _history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = pit.team_rows(matches(spark, sf_dir), "delay_hours", "status")
    at = lambda hours: (F.col("kickoff_at").cast("timestamp") + hours).cast("timestamp_ntz")
    known = at(F.make_dt_interval(hours=(F.col("delay_hours") + 3).cast("int")))
    history = rows.where("status != 'scheduled'").withColumn("eligible_at", known)
    targets = rows.withColumn("cutoff_at", at(-F.expr("INTERVAL 6 HOURS")))
    return targets, history


_ELIGIBLE = f"""
WITH {MATCHES}, {TEAM_ROWS},
t AS (SELECT fixture_id, team, kickoff_at, kickoff_at - INTERVAL 6 HOUR AS cutoff_at FROM team_rows),
p AS (SELECT t.*, h.fixture_id AS hf, h.kickoff_at AS hk, h.points, h.gf, h.ga, h.kickoff_at + to_hours(CAST(h.delay_hours + 3 AS INTEGER)) <= t.cutoff_at AND h.kickoff_at < t.cutoff_at AS fine
      FROM t JOIN team_rows h ON h.team = t.team AND h.status <> 'scheduled' AND h.kickoff_at < t.kickoff_at),
b AS (SELECT fixture_id, team, count(*) AS blocked FROM p WHERE NOT fine GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY fixture_id, team ORDER BY hk DESC, hf DESC) AS n FROM p WHERE fine),
a AS (SELECT fixture_id, team, count(*) AS seen, avg(points) AS pts, avg(gf) AS gf, avg(ga) AS ga, max(hk) AS hk FROM r WHERE n <= 5 GROUP BY ALL)"""


@query(f"""{_ELIGIBLE}
SELECT t.fixture_id, t.team, coalesce(a.seen, 0) AS matches_seen, round(a.pts, 6) AS points_avg, round(a.gf, 6) AS goals_for_avg, round(a.ga, 6) AS goals_against_avg,
  coalesce(b.blocked, 0) AS blocked, round((epoch_us(t.kickoff_at) - epoch_us(a.hk)) / 86400000000.0, 6) AS rest_days
FROM t LEFT JOIN a ON a.fixture_id = t.fixture_id AND a.team = t.team LEFT JOIN b ON b.fixture_id = t.fixture_id AND b.team = t.team""")
def eligible_history_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five that were eligible by the cut-off, however late each result became known."""
    out = pit.form_as_known(*_history(spark, sf_dir)).select("fixture_id", "team", "matches_seen", "points_avg", "goals_for_avg", "goals_against_avg", "blocked", "rest_days")
    return _rounded(out, "points_avg", "goals_for_avg", "goals_against_avg", "rest_days")


@query(f"""{_ELIGIBLE}
SELECT t.fixture_id, t.team,
  CASE WHEN coalesce(b.blocked, 0) > 0 AND coalesce(a.seen, 0) = 0 THEN 'pit_ineligible' ELSE 'observed' END AS seen_state,
  CASE WHEN coalesce(b.blocked, 0) > 0 AND a.pts IS NULL THEN 'pit_ineligible' WHEN a.pts IS NOT NULL THEN 'observed' ELSE 'missing' END AS points_state,
  NOT (coalesce(b.blocked, 0) > 0 AND coalesce(a.seen, 0) = 0) AS pit_eligible
FROM t LEFT JOIN a ON a.fixture_id = t.fixture_id AND a.team = t.team LEFT JOIN b ON b.fixture_id = t.fixture_id AND b.team = t.team""")
def feature_missingness_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 V5: why each feature is as it is, and whether the snapshot may be used."""
    out = pit.form_as_known(*_history(spark, sf_dir))
    blocked = F.col("blocked") > 0
    out = out.withColumn("seen_state", pit.missingness(F.col("matches_seen"), blocked, counts=True)).withColumn("points_state", pit.missingness(F.col("points_avg"), blocked))
    return out.select("fixture_id", "team", "seen_state", "points_state", ((F.col("seen_state") != "pit_ineligible") & (F.col("points_state") != "pit_ineligible")).alias("pit_eligible"))


_BASIS = "CASE o_custkey % 5 WHEN 0 THEN 'actual_source_timestamp' WHEN 1 THEN 'knowledge_timestamp' WHEN 2 THEN 'revision_timestamp' WHEN 3 THEN 'event_derived_reconstruction' ELSE 'unknown' END"


@query(f"""
SELECT o_orderkey AS fixture_id, basis, CASE WHEN basis IN ('actual_source_timestamp', 'revision_timestamp') THEN greatest(av, kn) WHEN basis = 'knowledge_timestamp' THEN kn
  WHEN basis = 'event_derived_reconstruction' THEN o_orderdate + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 30 HOUR ELSE INTERVAL 3 HOUR END END AS eligible_at
FROM (SELECT *, {_BASIS} AS basis, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 5 AS INTEGER)) END AS av, o_orderdate + INTERVAL 4 HOUR AS kn FROM orders)""")
def eligibility_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: when a result may be used, by the basis it is known on."""
    o = table(spark, sf_dir, "orders")
    at = lambda delta: (F.col("o_orderdate").cast("timestamp") + delta).cast("timestamp_ntz")
    names = F.array(*(F.lit(b) for b in (pit.ACTUAL, pit.KNOWN, pit.REVISION, pit.DERIVED, pit.UNKNOWN)))
    o = o.withColumn("basis", F.get(names, F.pmod("o_custkey", F.lit(5)).cast("int")))
    available = F.when(F.pmod("o_orderkey", F.lit(3)) != 0, at(F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(5)).cast("int"))))
    local = F.when(F.pmod("o_orderkey", F.lit(2)) != 0, F.lit("15:00"))
    when = pit.eligible_at(F.col("basis"), available, at(F.expr("INTERVAL 4 HOURS")), F.col("o_orderdate"), local, F.lit(None).cast("timestamp_ntz"))
    return o.select(F.col("o_orderkey").alias("fixture_id"), "basis", when.alias("eligible_at"))


@query("""
SELECT o_custkey AS team, CASE WHEN count(DISTINCT basis) = 1 THEN min(basis) WHEN bool_or(basis = 'unknown') THEN 'unknown' WHEN bool_or(basis = 'event_derived_reconstruction') THEN 'event_derived_reconstruction' ELSE 'revision_timestamp' END AS basis
FROM (SELECT o_custkey, CASE o_orderkey % 4 WHEN 0 THEN 'actual_source_timestamp' WHEN 1 THEN 'knowledge_timestamp' WHEN 2 THEN 'event_derived_reconstruction' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE 'revision_timestamp' END END AS basis FROM orders)
GROUP BY o_custkey""")
def basis_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The basis of a feature made of several matches."""
    k = F.col("o_orderkey")
    basis = F.when(k % 4 == 0, pit.ACTUAL).when(k % 4 == 1, pit.KNOWN).when(k % 4 == 2, pit.DERIVED).when(k % 3 == 0, pit.UNKNOWN).otherwise(pit.REVISION)
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("team")).agg(F.collect_set(basis).alias("b")).select("team", pit.merged_basis(F.col("b")).alias("basis"))


@query("""
SELECT o_custkey AS team, o_orderkey AS fixture_id, coalesce(max(blocks) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS provider_blocked
FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS blocks FROM orders)""")
def provider_chronology_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: whether any earlier match of the team has a basis that blocks provider features."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("team"), F.col("o_orderkey").alias("fixture_id"), F.struct("o_orderdate", "o_orderkey").alias("at"), (F.pmod("o_orderkey", F.lit(11)) == 0).alias("blocks"))
    first = o.where("blocks").groupBy("team").agg(F.min("at").alias("first"))
    return o.join(first, "team", "left").select("team", "fixture_id", F.coalesce(F.col("first") < F.col("at"), F.lit(False)).alias("provider_blocked"))


@query(f"""
WITH {LEDGER} SELECT entry_id, fixture_id, capability, knowledge_at FROM ledger WHERE knowledge_at <= TIMESTAMP '2024-01-15 00:00:00' AND state = 'success'""")
def ledger_as_known_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: successful entries known by a time."""
    return pit.as_known_at(ledger(spark, sf_dir), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("entry_id", "fixture_id", "capability", "knowledge_at")


@query(f"""
WITH {LEDGER} SELECT fixture_id, capability, arg_max(entry_id, struct_pack(a := knowledge_at, b := entry_id)) AS entry_id, max(knowledge_at) AS knowledge_at FROM ledger WHERE state = 'success' GROUP BY fixture_id, capability""")
def latest_per_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest entry of each fixture and capability."""
    rows = ledger(spark, sf_dir).where("state = 'success'").select("fixture_id", "capability", "entry_id", "knowledge_at")
    return ordered.latest_by(rows, ["fixture_id", "capability"], F.col("knowledge_at"), F.col("entry_id"))


@query(f"""
WITH {LEDGER} SELECT fixture_id, source, capability, min(knowledge_at) AS first_observed_at, arg_min(entry_id, struct_pack(a := knowledge_at, b := entry_id)) AS entry_id FROM ledger GROUP BY fixture_id, source, capability""")
def first_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each fixture was first seen, per source and capability."""
    rows = ledger(spark, sf_dir).select("fixture_id", "source", "capability", F.col("knowledge_at").alias("first_observed_at"), "entry_id")
    return ordered.earliest_by(rows, ["fixture_id", "source", "capability"], F.col("first_observed_at"), F.col("entry_id"))


@query(f"""
WITH {LEDGER}, f AS (SELECT entry_id, fixture_id, knowledge_at FROM ledger WHERE capability = 'purchase'),
v AS (SELECT entry_id, fixture_id, knowledge_at FROM ledger WHERE capability = 'view'),
r AS (SELECT f.entry_id, v.entry_id AS as_of_entry, row_number() OVER (PARTITION BY f.entry_id ORDER BY v.knowledge_at DESC, v.entry_id) AS n FROM f JOIN v ON v.fixture_id = f.fixture_id AND v.knowledge_at <= f.knowledge_at)
SELECT CAST(entry_id AS VARCHAR) AS entry_id, CAST(as_of_entry AS VARCHAR) AS as_of_entry FROM r WHERE n = 1""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase the latest view of the same fixture known by then."""
    rows = ledger(spark, sf_dir).select(F.col("entry_id").cast("string").alias("id"), F.col("fixture_id").cast("string").alias("entity"), "capability", F.col("knowledge_at").alias("at"))
    events = rows.where("capability = 'purchase'").select(F.col("id").alias("event_id"), "entity", "at")
    versions = rows.where("capability = 'view'").select(F.col("id").alias("version_id"), "entity", F.col("at").alias("known_at"))
    return asof.as_known_at(events, versions).select(F.col("event_id").alias("entry_id"), F.col("version_id").alias("as_of_entry"))


@query(f"""
WITH {MATCHES} SELECT fixture_id, season, CASE WHEN home_goals > away_goals THEN 'HOME' WHEN home_goals = away_goals THEN 'DRAW' ELSE 'AWAY' END AS outcome FROM matches WHERE status = 'completed' ORDER BY kickoff_at, fixture_id LIMIT 100""")
def first_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recovery batch, the first hundred completed matches in order."""
    rows = matches(spark, sf_dir).where("status = 'completed'").orderBy("kickoff_at", "fixture_id").limit(100)
    return rows.select("fixture_id", "season", N.outcome(F.col("home_goals"), F.col("away_goals")).alias("outcome"))
