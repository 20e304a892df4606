"""Operations, tasks, live views, track records, and the extensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.operators import health, ordered, shadow, tasks
from chronopitch.plans.domain import LEDGER, MATCHES, TEAM_ROWS, ledger, matches
from chronopitch.plans.model_queries import FORECASTS, _forecasts
from chronopitch.operators import evaluation, pit
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


@query(f"""WITH {LEDGER}, s AS (SELECT *, state = 'success' AS ok, CASE WHEN state <> 'success' THEN 'http_' || CAST(entry_id % 3 AS VARCHAR) END AS fc FROM ledger),
c AS (SELECT source, capability, string_agg(fc || '=' || CAST(n AS VARCHAR), ',' ORDER BY fc || '=' || CAST(n AS VARCHAR)) AS failure_classes FROM (SELECT source, capability, fc, count(*) AS n FROM s WHERE fc IS NOT NULL GROUP BY ALL) GROUP BY ALL),
a AS (SELECT source, capability, count(*) AS attempts, count(*) FILTER (WHERE ok) AS successes, count(*) FILTER (WHERE NOT ok) AS failures, max(knowledge_at) AS last_attempt_at, max(CASE WHEN ok THEN knowledge_at END) AS last_success_at, arg_max(value, struct_pack(a := knowledge_at, b := entry_id)) AS last_latency_ms FROM s GROUP BY ALL)
SELECT a.*, c.failure_classes, CASE WHEN successes > 0 AND failures > 0 THEN 'DEGRADED' WHEN failures > 0 THEN 'FAILED' ELSE 'HEALTHY' END AS state FROM a LEFT JOIN c ON a.source = c.source AND a.capability = c.capability""")
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health per source and capability, recomputed from the log."""
    rows = ledger(spark, sf_dir)
    signals = rows.select("source", "capability", F.col("knowledge_at").alias("attempted_at"), F.col("entry_id").alias("signal_id"), (F.col("state") == "success").alias("success"), F.col("value").alias("latency_ms"), F.when(F.col("state") != "success", F.format_string("http_%d", F.pmod("entry_id", F.lit(3)))).alias("failure_class"))
    return health.source_health(signals, ["source", "capability"])


@query(f"""WITH RECURSIVE {LEDGER}, o AS (SELECT CAST(fixture_id AS VARCHAR) || ':' || source AS key, entry_id, k % 3 = 0 AS ok, epoch_us(knowledge_at) AS t, row_number() OVER (PARTITION BY fixture_id, source ORDER BY knowledge_at, entry_id) AS n FROM ledger),
f AS (SELECT key, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS entry_id, 'CLOSED' AS state, CAST(0 AS BIGINT) AS failures, CAST(0 AS BIGINT) AS opened FROM (SELECT DISTINCT key FROM o)
  UNION ALL SELECT key, n, entry_id, CASE WHEN ok THEN 'CLOSED' WHEN cooled = 'HALF_OPEN' OR failures + 1 >= 3 THEN 'OPEN' ELSE cooled END, CASE WHEN ok THEN 0 WHEN cooled = 'HALF_OPEN' THEN failures ELSE failures + 1 END,
    CASE WHEN NOT ok AND (cooled = 'HALF_OPEN' OR failures + 1 >= 3) THEN t ELSE opened END
  FROM (SELECT o.key, o.n, o.entry_id, o.ok, o.t, f.failures, f.opened, CASE WHEN f.state = 'OPEN' AND o.t - f.opened >= 120000000 THEN 'HALF_OPEN' ELSE f.state END AS cooled FROM f JOIN o ON o.key = f.key AND o.n = f.n + 1) s)
SELECT entry_id AS attempt_id, state AS circuit_state FROM f WHERE n > 0""")
def circuit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each source's circuit after each attempt."""
    rows = ledger(spark, sf_dir).select(F.concat_ws(":", "fixture_id", "source").alias("key"), F.col("knowledge_at").alias("attempted_at"), F.col("entry_id").alias("attempt_id"), (F.pmod("k", F.lit(3)) == 0).alias("success"))
    return health.circuit(rows)


_STATES = "CASE entry_id % 11 WHEN 0 THEN 'failed' WHEN 1 THEN 'schema_drift' WHEN 2 THEN 'quarantined' WHEN 3 THEN 'missing' WHEN 4 THEN 'unsupported' ELSE 'supported' END"


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*(F.lit(s) for s in health.PRIORITY))
    return ledger(spark, sf_dir).withColumn("state", F.get(names, F.least(F.pmod("entry_id", F.lit(11)), F.lit(5)).cast("int")))


@query(f"""WITH {LEDGER}, a AS (SELECT fixture_id, capability, {_STATES} AS state FROM ledger), r AS (SELECT *, list_position(['failed', 'schema_drift', 'quarantined', 'missing', 'unsupported', 'supported'], state) AS p FROM a)
SELECT fixture_id, capability, arg_min(state, p) AS state, count(*) AS attempts FROM r GROUP BY ALL""")
def final_state_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final state of a run by its weightiest attempt."""
    return health.final_state(_attempts(spark, sf_dir), ["fixture_id", "capability"])


@query(f"""WITH {LEDGER}, a AS (SELECT fixture_id, capability, source, {_STATES} = 'supported' AS ok FROM ledger),
b AS (SELECT *, min(CASE WHEN ok THEN source END) OVER (PARTITION BY fixture_id, capability) AS served FROM a)
SELECT fixture_id, capability, min(served) AS source, count(*) AS attempts, count(*) FILTER (WHERE NOT ok AND (served IS NULL OR source < served)) AS failed_before FROM b GROUP BY ALL""")
def fallback_first_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source in policy order that serves a request."""
    return health.first_supported(_attempts(spark, sf_dir), ["fixture_id", "capability"], F.col("source"), F.col("state") == "supported")


@query(f"""WITH {LEDGER} SELECT source, count(*) AS n_rows, count(DISTINCT k) AS keys, round(avg((CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END + CASE WHEN k > 50 THEN 1.0 ELSE 0.0 END) / 2), 6) AS missing_rate, CAST(100 AS BIGINT) AS expected, count(*) - count(DISTINCT k) AS duplicates, round(least(1.0, count(DISTINCT k) / 100.0), 6) AS coverage,
  CASE WHEN least(1.0, count(DISTINCT k) / 100.0) >= 0.6 AND avg((CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END + CASE WHEN k > 50 THEN 1.0 ELSE 0.0 END) / 2) <= 0.2 THEN 'fallback' ELSE 'reject' END AS recommendation FROM ledger GROUP BY source""")
def qualification_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How complete each source is, and what that makes it good for."""
    rows = ledger(spark, sf_dir).withColumn("k2", F.when(F.col("k") <= 50, F.col("k")))
    out = health.qualification(rows, ["source"], "k", ["value", "k2"], F.lit(100).cast("long"))
    out = out.withColumn("recommendation", health.recommendation(F.col("coverage"), F.col("missing_rate"), F.col("duplicates")))
    return _rounded(out, "missing_rate", "coverage")


@query(f"""WITH {LEDGER} SELECT capability, count(*) AS n_entries, count(DISTINCT fixture_id) AS fixtures, count(*) FILTER (WHERE state = 'success') AS supported, count(*) FILTER (WHERE state <> 'success') AS failed, max(knowledge_at) AS last_known_at FROM ledger WHERE knowledge_at <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY capability""")
def operational_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 2.12: coverage per capability as known at a time."""
    rows = ledger(spark, sf_dir).where(F.col("knowledge_at") <= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return rows.groupBy("capability").agg(F.count("*").alias("n_entries"), F.count_distinct("fixture_id").alias("fixtures"), F.count_if(F.col("state") == "success").alias("supported"), F.count_if(F.col("state") != "success").alias("failed"), F.max("knowledge_at").alias("last_known_at"))


@query("""SELECT entity_type, count(*) AS identities, count(DISTINCT canonical_id) AS canonical, count(*) FILTER (WHERE canonical_id IS NULL) AS unresolved FROM (SELECT lower(trim(entity_type)) AS entity_type, canonical_id FROM source_observation UNION ALL SELECT lower(trim(entity_type)), canonical_id FROM canonical_entities) GROUP BY entity_type""")
def identity_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many identities are resolved."""
    both = table(spark, sf_dir, "source_observation").select("entity_type", "canonical_id").unionByName(table(spark, sf_dir, "canonical_entities").select("entity_type", "canonical_id"))
    return both.groupBy(F.lower(F.trim("entity_type")).alias("entity_type")).agg(F.count("*").alias("identities"), F.count_distinct("canonical_id").alias("canonical"), F.count_if(F.col("canonical_id").isNull()).alias("unresolved"))


_OFFSETS = "(VALUES ('t-72h', 259200), ('t-24h', 86400), ('t-6h', 21600), ('t-1h', 3600), ('t-15m', 900)) AS hz(horizon, off)"


@query(f"""WITH {MATCHES} SELECT fixture_id, kickoff_at, horizon, capability, kickoff_at - to_seconds(off) AS scheduled_for FROM matches, {_OFFSETS}, (VALUES ('lineups'), ('odds_board')) AS cp(capability)""")
def horizon_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fixture's tasks."""
    return tasks.schedule(matches(spark, sf_dir).select("fixture_id", "kickoff_at"), ["lineups", "odds_board"])


@query("""WITH t AS (SELECT DISTINCT task_id, scheduled_for FROM observation_task), o AS (SELECT task_id, CASE ascii(substr(task_id, 1, 1)) % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'missing' END AS outcome FROM t)
SELECT t.task_id, CASE WHEN outcome = 'success' THEN 'success' WHEN scheduled_for > TIMESTAMPTZ '2024-10-01 12:00:00+00' THEN 'pending' WHEN scheduled_for >= TIMESTAMPTZ '2024-10-01 11:45:00+00' THEN 'due' ELSE 'missed_observation' END AS state FROM t JOIN o ON o.task_id = t.task_id""")
def due_and_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is due, pending, done or missed at a time; what is missed is never made up for."""
    rows = table(spark, sf_dir, "observation_task").select("task_id", "scheduled_for").distinct()
    first = F.ascii(F.substring("task_id", 1, 1)) % 4
    outcome = F.when(first == 0, "success").when(first == 1, "missing")
    return rows.select("task_id", tasks.task_state(F.col("scheduled_for"), F.lit("2024-10-01 12:00:00").cast("timestamp"), outcome).alias("state"))


@query("""WITH t AS (SELECT DISTINCT task_id, lower(trim(fixture_id)) AS f, kickoff_at, horizon, capability, created_at FROM observation_task), c AS (SELECT f, horizon, capability, arg_max(kickoff_at, struct_pack(a := created_at, b := task_id)) AS cur FROM t GROUP BY ALL)
SELECT t.task_id, t.f AS fixture_id, t.horizon FROM t JOIN c ON c.f = t.f AND c.horizon = t.horizon AND c.capability = t.capability WHERE t.kickoff_at <> c.cur AND t.horizon <> 'fixture_first_observed' AND ascii(substr(task_id, 1, 1)) % 4 <> 0""")
def reschedule_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open tasks of a kick-off that has moved."""
    t = table(spark, sf_dir, "observation_task").select("task_id", F.lower(F.trim("fixture_id")).alias("fixture_id"), "kickoff_at", "horizon", "capability", "created_at").distinct()
    first = F.ascii(F.substring("task_id", 1, 1)) % 4
    outcomes = t.select("task_id", F.when(first == 0, "success").when(first == 1, "missing").alias("state"), F.col("created_at").alias("recorded_at")).where("state IS NOT NULL")
    return tasks.superseded(t, outcomes)


@query(f"""WITH RECURSIVE {LEDGER}, o AS (SELECT fixture_id, entry_id, epoch_us(knowledge_at) AS t, row_number() OVER (PARTITION BY fixture_id ORDER BY knowledge_at, entry_id) AS n FROM ledger),
f AS (SELECT fixture_id, n, entry_id, t AS last, TRUE AS due FROM o WHERE n = 1
  UNION ALL SELECT o.fixture_id, o.n, o.entry_id, CASE WHEN o.t - f.last >= 86400000000 THEN o.t ELSE f.last END, o.t - f.last >= 86400000000 FROM f JOIN o ON o.fixture_id = f.fixture_id AND o.n = f.n + 1)
SELECT entry_id AS poll_id FROM f WHERE due""")
def cadence_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls that keep a cadence of a day."""
    return tasks.cadence(ledger(spark, sf_dir).select(F.col("fixture_id").alias("key"), F.col("knowledge_at").alias("at"), F.col("entry_id").alias("poll_id")), 86_400)


_SHADOW = "o_orderkey AS run_id, o_orderdate AS kickoff_at, o_orderdate - to_hours(CAST(o_orderkey % 9 AS INTEGER)) AS cutoff_at, o_orderdate - to_hours(CAST(o_orderkey % 11 AS INTEGER)) AS knowledge_at, o_orderdate - to_hours(CAST(o_orderkey % 7 AS INTEGER)) AS created_at"


def _shadow(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = lambda n: (F.col("o_orderdate").cast("timestamp") - F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(n)).cast("int"))).cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("kickoff_at"), back(9).alias("cutoff_at"), back(11).alias("knowledge_at"), back(7).alias("created_at"))


@query(f"""SELECT run_id, coalesce(knowledge_at <= cutoff_at AND cutoff_at <= kickoff_at AND knowledge_at <= created_at AND created_at < kickoff_at AND greatest(cutoff_at, created_at, knowledge_at) < kickoff_at, FALSE) AS eligible FROM (SELECT {_SHADOW} FROM orders)""")
def shadow_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: forecasts that were truly made before their match."""
    c = F.col
    cutoff = F.greatest("cutoff_at", "created_at", "knowledge_at")
    fine = shadow.eligible(c("kickoff_at"), c("cutoff_at"), c("knowledge_at"), c("created_at"), c("created_at"), cutoff, F.array("knowledge_at"))
    return _shadow(spark, sf_dir).select("run_id", fine.alias("eligible"))


@query(f"""SELECT run_id, greatest(cutoff_at, created_at, knowledge_at, created_at + INTERVAL 20 MINUTE) AS prediction_cutoff_at FROM (SELECT {_SHADOW} FROM orders) WHERE greatest(cutoff_at, created_at, knowledge_at, created_at + INTERVAL 20 MINUTE) < kickoff_at""")
def attestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: staged forecasts stamped when stored, before kick-off only."""
    stored = (F.col("created_at").cast("timestamp") + F.expr("INTERVAL 20 MINUTES")).cast("timestamp_ntz")
    return shadow.attested(_shadow(spark, sf_dir), stored).select("run_id", "prediction_cutoff_at")


_SETTLE = """rs AS (SELECT fixture_id, row_id AS result_id, knowledge_at, home_goals, away_goals FROM live_fixture WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL AND knowledge_at IS NOT NULL),
ch AS (SELECT * FROM (SELECT *, lag(home_goals) OVER w AS lh, lag(away_goals) OVER w AS la, row_number() OVER w AS rn FROM rs WINDOW w AS (PARTITION BY fixture_id ORDER BY knowledge_at, result_id)) WHERE rn = 1 OR lh <> home_goals OR la <> away_goals),
st AS (SELECT 'run-' || fixture_id AS run_id, fixture_id, row_number() OVER (PARTITION BY fixture_id ORDER BY knowledge_at, result_id) AS n, home_goals, away_goals, knowledge_at AS settled_at FROM ch),
se AS (SELECT run_id, fixture_id, 's:' || run_id || ':' || CAST(n AS VARCHAR) AS settlement_id, CASE WHEN n > 1 THEN 's:' || run_id || ':' || CAST(n - 1 AS VARCHAR) END AS correction_of, home_goals, away_goals, settled_at FROM st)"""


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "live_fixture")
    runs = live.select("fixture_id").distinct().withColumn("run_id", F.concat(F.lit("run-"), "fixture_id"))
    results = live.where("home_goals IS NOT NULL AND away_goals IS NOT NULL").select("fixture_id", F.col("row_id").alias("result_id"), "knowledge_at", "home_goals", "away_goals")
    return shadow.settlements(runs, results, F.lit("2100-01-01").cast("timestamp"))


@query(f"""WITH {_SETTLE} SELECT * FROM se""")
def settlement_with_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlements, each correcting the one before it."""
    return _settled(spark, sf_dir)


@query(f"""WITH {_SETTLE}, l AS (SELECT * FROM se WHERE settlement_id NOT IN (SELECT correction_of FROM se WHERE correction_of IS NOT NULL)) SELECT substr(fixture_id, 9, 3) AS league, count(*) AS sample_count, round(avg(CAST(home_goals + away_goals AS DOUBLE)), 6) AS goals FROM l GROUP BY 1""")
def track_record_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over what no correction replaced."""
    rows = _settled(spark, sf_dir).withColumn("league", F.substring("fixture_id", 9, 3)).withColumn("goals", (F.col("home_goals") + F.col("away_goals")).cast("double"))
    return _rounded(shadow.track_record(rows, ["league"], ["goals"]), "goals")


@query(f"""WITH {FORECASTS} SELECT fixture_id AS run_id, home_team, away_team, round(p_home - lag(p_home) OVER w, 6) AS d_p_home, round(p_draw - lag(p_draw) OVER w, 6) AS d_p_draw, round(p_away - lag(p_away) OVER w, 6) AS d_p_away FROM fc WINDOW w AS (PARTITION BY home_team, away_team ORDER BY kickoff_at, fixture_id)""")
def forecast_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How forecasts of a pair moved from one run to the next."""
    runs = _forecasts(spark, sf_dir).withColumn("created_at", F.col("kickoff_at")).withColumn("run_id", F.col("fixture_id"))
    return _rounded(shadow.evolution(runs, ["home_team", "away_team"]), "d_p_home", "d_p_draw", "d_p_away")


@query("""SELECT fixture_id, arg_max(status, struct_pack(a := updated_at, b := row_id)) FILTER (WHERE status IS NOT NULL) AS status, arg_max(home_goals, struct_pack(a := updated_at, b := row_id)) FILTER (WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL) AS home_goals,
  arg_max(away_goals, struct_pack(a := updated_at, b := row_id)) FILTER (WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL) AS away_goals, max(knowledge_at) AS knowledge_at, max(updated_at) AS updated_at, count(*) AS updates FROM live_fixture GROUP BY fixture_id""")
def live_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live view of each fixture; a known score never goes."""
    rows = table(spark, sf_dir, "live_fixture").withColumn("update_id", F.col("row_id"))
    return shadow.projection(rows, "fixture_id")


@query("""SELECT fixture_id, arg_min(entry_id, struct_pack(a := knowledge_at, b := entry_id)) AS entry_id FROM ledger_entry WHERE state = 'success' AND NOT operational_probe AND capability = 'fixture_detail' AND knowledge_at >= TIMESTAMPTZ '2024-01-01 00:00:00+00' GROUP BY fixture_id""")
def cached_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest cached entry that may stand in for a failed discovery."""
    rows = table(spark, sf_dir, "ledger_entry").where("state = 'success' AND NOT operational_probe AND capability = 'fixture_detail' AND knowledge_at >= TIMESTAMP '2024-01-01 00:00:00'").select("fixture_id", "entry_id", "knowledge_at")
    return ordered.earliest_by(rows, ["fixture_id"], F.col("knowledge_at"), F.col("entry_id")).select("fixture_id", "entry_id")


@query("""SELECT t.task_id, t.fixture_id FROM (SELECT DISTINCT task_id, lower(trim(fixture_id)) AS fixture_id, kickoff_at, created_at FROM observation_task) t WHERE t.created_at <= t.kickoff_at""")
def discovery_before_kickoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: what is found after kick-off makes no tasks."""
    t = table(spark, sf_dir, "observation_task").select("task_id", F.lower(F.trim("fixture_id")).alias("fixture_id"), "kickoff_at", "created_at").distinct()
    return t.where("created_at <= kickoff_at").select("task_id", "fixture_id")


@query(f"""WITH {MATCHES}, {TEAM_ROWS} SELECT season, team, CAST(sum(points) AS BIGINT) AS points, count(*) AS played, round(avg(gf), 6) AS goals_per_match, rank() OVER (PARTITION BY season ORDER BY sum(points) DESC) AS place FROM team_rows WHERE status = 'completed' GROUP BY season, team HAVING count(*) >= 5""")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and places per season, with a least sample."""
    rows = pit.team_rows(matches(spark, sf_dir).where("status = 'completed'"), "season").groupBy("season", "team")
    out = rows.agg(F.sum("points").cast("bigint").alias("points"), F.count("*").alias("played"), F.round(F.avg("gf"), 6).alias("goals_per_match")).where("played >= 5")
    return out.withColumn("place", F.rank().over(Window.partitionBy("season").orderBy(F.desc("points"))).cast("bigint"))


@query(f"""WITH {MATCHES}, {TEAM_ROWS}, a AS (SELECT season, team, points = 3 AS won, row_number() OVER (PARTITION BY season, team ORDER BY kickoff_at, fixture_id) AS n, row_number() OVER (PARTITION BY season, team, points = 3 ORDER BY kickoff_at, fixture_id) AS m FROM team_rows WHERE status = 'completed'),
s AS (SELECT season, team, count(*) AS len FROM a WHERE won GROUP BY season, team, n - m) SELECT season, team, max(len) AS longest FROM s GROUP BY ALL""")
def winning_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of wins per team and season; a team's season is bounded by its fixtures."""
    rows = pit.team_rows(matches(spark, sf_dir).where("status = 'completed'"), "season").withColumn("won", F.col("points") == 3)
    n = F.row_number().over(Window.partitionBy("season", "team").orderBy("kickoff_at", "fixture_id"))
    m = F.row_number().over(Window.partitionBy("season", "team", "won").orderBy("kickoff_at", "fixture_id"))
    return rows.withColumn("island", n - m).where("won").groupBy("season", "team", "island").agg(F.count("*").alias("len")).groupBy("season", "team").agg(F.max("len").alias("longest"))


@query("""SELECT row_id, round(1 / b365h, 6) AS implied_home, round(1 / b365h + 1 / b365d + 1 / b365a - 1, 6) AS overround, greatest(b365h, avgh) AS best_home, round(b365h - avgh, 6) AS line_move
FROM (SELECT row_id, TRY_CAST(trim(b365h) AS DOUBLE) AS b365h, TRY_CAST(trim(b365d) AS DOUBLE) AS b365d, TRY_CAST(trim(b365a) AS DOUBLE) AS b365a, TRY_CAST(trim(avgh) AS DOUBLE) AS avgh FROM football_data_timezone) WHERE b365h > 1 AND b365d > 1 AND b365a > 1""")
def odds_overround(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implied probabilities, overround, best price and movement."""
    f = table(spark, sf_dir, "football_data_timezone").select("row_id", *(F.trim(c).try_cast("double").alias(c) for c in ("b365h", "b365d", "b365a", "avgh"))).where("b365h > 1 AND b365d > 1 AND b365a > 1")
    return f.select("row_id", F.round(1 / F.col("b365h"), 6).alias("implied_home"), F.round(1 / F.col("b365h") + 1 / F.col("b365d") + 1 / F.col("b365a") - 1, 6).alias("overround"), F.greatest("b365h", "avgh").alias("best_home"), F.round(F.col("b365h") - F.col("avgh"), 6).alias("line_move"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type, sum(value) AS v FROM events GROUP BY ALL)
SELECT day, event_type, round(v, 4) AS value, round(sum(v) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4) AS last_7_days, round(max(c) OVER (PARTITION BY event_type ORDER BY day) - c, 4) AS drawdown
FROM (SELECT *, sum(v - 40) OVER (PARTITION BY event_type ORDER BY day) AS c FROM d)""")
def rolling_and_drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling week and drawdown of daily totals: a row per day and type, whatever the number of events."""
    d = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.sum("value").alias("v"))
    w = Window.partitionBy("event_type").orderBy("day")
    d = d.withColumn("c", F.sum(F.col("v") - 40).over(w)).withColumn("n", F.datediff("day", F.lit("1970-01-01").cast("date")))
    week = F.sum("v").over(Window.partitionBy("event_type").orderBy("n").rangeBetween(-6, 0))
    return d.select("day", "event_type", F.round("v", 4).alias("value"), F.round(week, 4).alias("last_7_days"), F.round(F.max("c").over(w) - F.col("c"), 4).alias("drawdown"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 21600000000 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sn FROM g)
SELECT user_id, min(ts) AS started_at, count(*) AS n FROM s GROUP BY user_id, sn""")
def session_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: sessions with gaps of less than six hours, by session_window with partial merging."""
    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    out = e.groupBy("user_id", F.session_window("t", "6 hours").alias("s")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("started_at"), "n")


@query("""SELECT team, matches, round(percent_rank() OVER (ORDER BY matches), 6) AS percentile FROM (SELECT o_custkey AS team, count(*) AS matches FROM orders GROUP BY 1)""")
def percentile_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each team's percentile. Ranks come from a histogram of counts, so no task sorts all teams."""
    t = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("team")).agg(F.count("*").alias("matches"))
    h = t.groupBy("matches").agg(F.count("*").alias("n"))
    below = h.select("matches", (F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0).alias("_all")).orderBy("matches").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("below"))
    total = t.agg(F.count("*").alias("total"))
    return t.join(F.broadcast(below), "matches").crossJoin(F.broadcast(total)).select("team", "matches", F.round(F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(0.0), 6).alias("percentile"))  # a single row
