"""Read services and further views: paging, buckets, joint markets, windows, prospective snapshots, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.functions import probability as P
from chronopitch.operators import asof, health, ordered
from chronopitch.operators.evaluation import bin_of
from chronopitch.plans.domain import LEDGER, MATCHES, ledger, matches
from chronopitch.plans.model_queries import FORECASTS, GRID, LINES, RATES, _forecasts, _lines
from chronopitch.session import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(f"""WITH {MATCHES} SELECT fixture_id, kickoff_at, home_team, away_team, season FROM matches WHERE home_team < 10 AND (kickoff_at > TIMESTAMP '1995-03-01 00:00:00' OR (kickoff_at = TIMESTAMP '1995-03-01 00:00:00' AND fixture_id > 100)) ORDER BY kickoff_at, fixture_id LIMIT 50""")
def explorer_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page after a cursor, by its key: no offset, so every page costs the same."""
    at = F.lit("1995-03-01 00:00:00").cast("timestamp_ntz")
    after = (F.col("kickoff_at") > at) | ((F.col("kickoff_at") == at) & (F.col("fixture_id") > 100))
    return matches(spark, sf_dir).where((F.col("home_team") < 10) & after).orderBy("kickoff_at", "fixture_id").limit(50).select("fixture_id", "kickoff_at", "home_team", "away_team", "season")


@query(f"""WITH {FORECASTS} SELECT CAST(least(9, floor(p_home * 10)) AS INTEGER) AS bucket, count(*) AS n, round(avg(p_home), 6) AS mean_p, round(avg(CAST(actual = 0 AS INTEGER)), 6) AS hit_rate, round(avg(CAST(actual = 0 AS INTEGER)) - avg(p_home), 6) AS edge FROM fc GROUP BY 1""")
def probability_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rate and edge by bucket of probability."""
    rows = _forecasts(spark, sf_dir).withColumn("hit", (F.col("actual") == 0).cast("int"))
    out = rows.groupBy(bin_of(F.col("p_home")).alias("bucket")).agg(F.count("*").alias("n"), F.avg("p_home").alias("mean_p"), F.avg("hit").alias("hit_rate"))
    return out.select("bucket", "n", F.round("mean_p", 6).alias("mean_p"), F.round("hit_rate", 6).alias("hit_rate"), F.round(F.col("hit_rate") - F.col("mean_p"), 6).alias("edge"))


@query(f"""WITH {RATES}, {GRID} SELECT fixture_id, round(sum(CASE WHEN h > a AND h + a > 2.5 THEN p ELSE 0 END), 6) AS home_and_over, round(sum(CASE WHEN h = a AND h > 0 THEN p ELSE 0 END), 6) AS draw_and_both_score, round(sum(CASE WHEN h > a AND h + a < 0.5 THEN p ELSE 0 END), 6) AS contradiction FROM grid GROUP BY fixture_id""")
def same_match_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint probabilities of one match from its one grid; a contradiction has none."""
    joint = lambda test: F.round(P.total_where(*LINES, test), 6)
    return _lines(spark, sf_dir).select("fixture_id", joint(lambda h, a: h > a and h + a > 2.5).alias("home_and_over"), joint(lambda h, a: h == a and h > 0).alias("draw_and_both_score"), joint(lambda h, a: h > a and h + a < 0.5).alias("contradiction"))


@query("""SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: tumbling windows over the event stream."""
    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    out = e.groupBy("event_type", F.window("t", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")


@query("""WITH t AS (SELECT task_id, min(lower(trim(fixture_id))) AS f, min(scheduled_for) AS at_time FROM observation_task GROUP BY task_id), e AS (SELECT entry_id, min(lower(trim(fixture_id))) AS f, min(knowledge_at) AS k FROM ledger_entry WHERE state = 'success' AND NOT operational_probe GROUP BY entry_id)
SELECT t.task_id, count(e.entry_id) AS observations FROM t LEFT JOIN e ON e.f = t.f AND e.k <= t.at_time GROUP BY t.task_id""")
def prospective_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many successful entries of its fixture each task could see, by one running count over both tables."""
    t = table(spark, sf_dir, "observation_task").groupBy("task_id").agg(F.min(asof.same_key("fixture_id")).alias("f"), F.min("scheduled_for").alias("at"))
    e = table(spark, sf_dir, "ledger_entry").where("state = 'success' AND NOT operational_probe").groupBy("entry_id").agg(F.min(asof.same_key("fixture_id")).alias("f"), F.min("knowledge_at").alias("at"))
    line = t.select("task_id", "f", F.unix_micros("at").alias("o"), F.lit(0).cast("long").alias("one")).unionByName(e.select(F.lit(None).cast("string").alias("task_id"), "f", F.unix_micros("at").alias("o"), F.lit(1).cast("long").alias("one")))
    return ordered.with_running(line, ["f"], "o", {"observations": F.col("one")}, strictly=False).where("task_id IS NOT NULL").select("task_id", "observations")


@query("""SELECT entry_id, min(CASE state WHEN 'success' THEN 'HEALTHY' WHEN 'supported' THEN 'HEALTHY' WHEN 'missing' THEN 'DEGRADED' WHEN 'unsupported' THEN 'DEGRADED' ELSE 'FAILED' END) AS health FROM ledger_entry GROUP BY entry_id""")
def health_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry's state as health."""
    return table(spark, sf_dir, "ledger_entry").groupBy("entry_id").agg(F.min(health.health_signal(F.col("state"))).alias("health"))


@query(f"""WITH {LEDGER}, p AS (SELECT source, list_sort(list(DISTINCT capability)) AS caps FROM ledger WHERE k < 5 GROUP BY source), n AS (SELECT source, list_sort(list(DISTINCT capability)) AS caps FROM ledger WHERE k < 50 AND capability <> 'error' GROUP BY source)
SELECT n.source, len(list_filter(p.caps, lambda c: NOT list_contains(n.caps, c))) = 0 AS may_replace, array_to_string(list_filter(p.caps, lambda c: NOT list_contains(n.caps, c)), ',') AS lost FROM n JOIN p ON p.source = n.source""")
def manifest_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version may replace another only if it loses none of its capabilities."""
    rows = ledger(spark, sf_dir)
    old = rows.where("k < 5").groupBy("source").agg(F.array_sort(F.collect_set("capability")).alias("old"))
    new = rows.where("k < 50 AND capability != 'error'").groupBy("source").agg(F.collect_set("capability").alias("new"))
    lost = F.array_except("old", "new")
    return new.join(old, "source").select("source", (F.size(lost) == 0).alias("may_replace"), F.array_join(lost, ",").alias("lost"))


@query("""SELECT entry_id, 'hd-' || substr(sha256('=' || min(source) || chr(31) || '=' || min(capability) || chr(31) || coalesce('=' || min(fixture_id), '-')), 1, 32) AS ledger_id, min(source) AS source FROM ledger_entry GROUP BY entry_id""")
def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows with ids by content, success or not."""
    rows = table(spark, sf_dir, "ledger_entry").groupBy("entry_id").agg(F.min("source").alias("source"), F.min("capability").alias("capability"), F.min("fixture_id").alias("fixture_id"))
    return rows.select("entry_id", N.content_id("hd-", F.col("source"), F.col("capability"), F.col("fixture_id")).alias("ledger_id"), "source")


@query("""SELECT season, competition, status, count(*) AS revisions, count(DISTINCT fixture_id) AS fixtures FROM (SELECT upper(trim(competition)) AS competition, season, status, fixture_id FROM live_fixture WHERE updated_at <= TIMESTAMPTZ '2024-06-01 00:00:00+00') GROUP BY ALL""")
def upcoming_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.12: fixtures as known at a time, by season, competition and status."""
    rows = table(spark, sf_dir, "live_fixture").where("updated_at <= TIMESTAMP '2024-06-01 00:00:00'")
    return rows.groupBy("season", F.upper(F.trim("competition")).alias("competition"), "status").agg(F.count("*").alias("revisions"), F.count_distinct("fixture_id").alias("fixtures"))
