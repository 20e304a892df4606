"""Parsers run end to end: payloads are built of the driver's matches, parsed, and compared with the matches themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.plans.domain import MATCHES, matches
from chronopitch.sources import payloads

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir).where("status = 'completed'").withColumn("id", F.col("fixture_id").cast("string"))


def _payload(rows: DataFrame, body: F.Column) -> DataFrame:
    return rows.select(F.concat(F.lit("ev-"), "id").alias("evidence_id"), F.to_json(body).alias("payload"))


def _team(c: str) -> F.Column:
    return F.struct(F.col(c).cast("string").alias("id"), F.concat(F.lit("Team "), F.col(c).cast("string")).alias("displayName"))


def _flat(parsed: DataFrame, *names: str) -> DataFrame:
    return parsed.select("evidence_id", "entity_type", "source_id", *(F.col("attributes")[n].alias(n) for n in names))


_DONE = f"WITH {MATCHES}, d AS (SELECT *, 'ev-' || CAST(fixture_id AS VARCHAR) AS ev, CAST(fixture_id AS VARCHAR) AS id, CAST(home_team AS VARCHAR) AS h, CAST(away_team AS VARCHAR) AS a, CAST(home_goals AS VARCHAR) AS hg, CAST(away_goals AS VARCHAR) AS ag FROM matches WHERE status = 'completed')"


@query(f"""{_DONE} SELECT ev AS evidence_id, 'fixture' AS entity_type, id AS source_id, h AS home_team, a AS away_team, hg AS home_goals, ag AS away_goals FROM d
UNION ALL SELECT ev, 'team', h, NULL, NULL, NULL, NULL FROM d UNION ALL SELECT ev, 'team', a, NULL, NULL, NULL, NULL FROM d""")
def parse_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures and teams of a scoreboard, sides by homeAway."""
    side = lambda w: F.struct(F.lit(w).alias("homeAway"), F.col(f"{w}_goals").cast("string").alias("score"), _team(f"{w}_team").alias("team"))
    event = F.struct("id", F.concat(F.lit("Match "), "id").alias("name"), F.date_format("kickoff_at", "yyyy-MM-dd'T'HH:mm'Z'").alias("date"), F.array(F.struct(F.array(side("away"), side("home")).alias("competitors"))).alias("competitions"))
    parsed = payloads.scoreboard(_payload(_done(spark, sf_dir), F.struct(F.array(event).alias("events"))))
    return _flat(parsed, "home_team", "away_team", "home_goals", "away_goals")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'team' AS entity_type, h AS source_id, 'Team ' || h AS name FROM d""")
def parse_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams of a list nested in sports and leagues."""
    body = F.struct(F.array(F.struct(F.array(F.struct(F.array(F.struct(_team("home_team").alias("team"))).alias("teams"))).alias("leagues"))).alias("sports"))
    return payloads.teams(_payload(_done(spark, sf_dir), body)).select("evidence_id", "entity_type", "source_id", "name")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'player' AS entity_type, id || '-' || h AS source_id, CASE WHEN home_goals > 2 THEN 'Forward' END AS position FROM d""")
def parse_athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players with a position where there is one."""
    player = F.struct(F.concat_ws("-", "id", F.col("home_team").cast("string")).alias("id"), F.lit("P").alias("displayName"), F.when(F.col("home_goals") > 2, F.struct(F.lit("Forward").alias("name"))).alias("position"))
    return _flat(payloads.athletes(_payload(_done(spark, sf_dir), F.struct(F.array(player).alias("athletes")))), "position")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'lineup' AS entity_type, id || ':' || h || ':7' AS source_id, CAST(home_goals > 0 AS VARCHAR) AS starter, NULL AS goals, NULL AS possession FROM d
UNION ALL SELECT ev, 'player_stat', id || ':' || h || ':7', NULL, CAST(CAST(home_goals AS DOUBLE) AS VARCHAR), NULL FROM d UNION ALL SELECT ev, 'team_stat', id || ':' || a, NULL, NULL, ag || '0%' FROM d""")
def parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-ups, player statistics and team statistics of a summary."""
    text = lambda c: F.col(c).cast("string")
    player = F.struct((F.col("home_goals") > 0).alias("starter"), F.struct(F.lit("7").alias("id"), F.lit("P").alias("displayName")).alias("athlete"), F.array(F.struct(F.lit("goals").alias("name"), F.col("home_goals").cast("double").alias("value"))).alias("stats"))
    box = F.struct(F.array(F.struct(F.struct(text("away_team").alias("id")).alias("team"), F.array(F.struct(F.lit("possession").alias("name"), F.concat(text("away_goals"), F.lit("0%")).alias("displayValue"))).alias("statistics"))).alias("teams"))
    body = F.struct(F.struct("id").alias("header"), F.array(F.struct(F.struct(text("home_team").alias("id")).alias("team"), F.array(player).alias("roster"))).alias("rosters"), box.alias("boxscore"))
    return _flat(payloads.summary(_payload(_done(spark, sf_dir), body)), "starter", "goals", "possession")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'fixture' AS entity_type, id AS source_id, h AS home_team, a AS away_team, hg AS home_goals, ag AS away_goals FROM d
UNION ALL SELECT ev, 'competition', '17', NULL, NULL, NULL, NULL FROM d UNION ALL SELECT ev, 'team', h, NULL, NULL, NULL, NULL FROM d UNION ALL SELECT ev, 'team', a, NULL, NULL, NULL, NULL FROM d""")
def parse_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event or a list of them (here alternating)."""
    side = lambda w: F.struct(F.col(f"{w}_team").alias("id"), F.concat(F.lit("Team "), F.col(f"{w}_team").cast("string")).alias("name"))
    event = F.struct(
        F.col("fixture_id").alias("id"), F.unix_seconds(F.col("kickoff_at").cast("timestamp")).alias("startTimestamp"), F.struct(F.lit("finished").alias("type")).alias("status"), side("home").alias("homeTeam"), side("away").alias("awayTeam"),
        F.struct(F.col("home_goals").alias("current")).alias("homeScore"), F.struct(F.col("away_goals").alias("current")).alias("awayScore"), F.struct(F.struct(F.lit(17).alias("id"), F.lit("League").alias("name")).alias("uniqueTournament")).alias("tournament"),
    )
    one = F.pmod("fixture_id", F.lit(2)) == 0
    body = F.struct(F.when(one, event).alias("event"), F.when(~one, F.array(event)).alias("events"))
    return _flat(payloads.detail(_payload(_done(spark, sf_dir), body)), "home_team", "away_team", "home_goals", "away_goals")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'lineup' AS entity_type, id || ':' || h || ':1' AS source_id, 'home' AS side, CAST(home_goals % 2 = 0 AS VARCHAR) AS starter, NULL AS rating FROM d
UNION ALL SELECT ev, 'lineup', id || ':' || a || ':2', 'away', 'true', NULL FROM d UNION ALL SELECT ev, 'player_stat', id || ':' || a || ':2', NULL, NULL, '7.5' FROM d""")
def parse_lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides' players; who is no substitute starts."""
    player = lambda w, i, sub, stats: F.struct(F.array(F.struct(F.struct(F.lit(i).alias("id"), F.lit("P").alias("name")).alias("player"), F.col(f"{w}_team").alias("teamId"), sub.alias("substitute"), stats.alias("statistics"))).alias("players"))
    none = F.lit(None).cast("map<string,string>")
    body = F.struct(F.col("fixture_id").alias("event_id"), player("home", 1, F.pmod("home_goals", F.lit(2)) != 0, none).alias("home"), player("away", 2, F.lit(None).cast("boolean"), F.create_map(F.lit("rating"), F.lit("7.5"))).alias("away"))
    return _flat(payloads.lineups(_payload(_done(spark, sf_dir), body)), "side", "starter", "rating")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'team_stat' AS entity_type, id || ':home' AS source_id, CASE WHEN fixture_id % 2 = 0 THEN hg ELSE 'first' END AS shots FROM d UNION ALL SELECT ev, 'team_stat', id || ':away', CASE WHEN fixture_id % 2 = 0 THEN ag ELSE 'first' END FROM d""")
def parse_team_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole match's statistics, or the first period's where there is no whole."""
    period = lambda name, h, a: F.struct(name.alias("period"), F.array(F.struct(F.array(F.struct(F.lit("shots").alias("key"), h.alias("home"), a.alias("away"))).alias("statisticsItems"))).alias("groups"))
    whole = F.when(F.pmod("fixture_id", F.lit(2)) == 0, F.lit("ALL")).otherwise(F.lit("2ND"))
    body = F.struct(F.col("fixture_id").alias("event_id"), F.array(period(F.lit("1ST"), F.lit("first"), F.lit("first")), period(whole, F.col("home_goals").cast("string"), F.col("away_goals").cast("string"))).alias("statistics"))
    return _flat(payloads.team_statistics(_payload(_done(spark, sf_dir), body)), "shots")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'shot' AS entity_type, id || ':' || CASE WHEN n.i = 0 THEN '9' ELSE 'index-' || CAST(n.i AS VARCHAR) END AS source_id, CAST(n.i = 0 AS VARCHAR) AS home FROM d, (SELECT unnest([0, 1, 2]) AS i) n WHERE n.i < home_goals AND n.i <> 1""")
def parse_shots_on_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots with a value after the shot, by id or by place where there is none."""
    n = F.least("home_goals", F.lit(3)).cast("int")
    shots = F.transform(F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), F.lit(1), n), lambda i: F.struct(F.when(i == 0, 9).alias("id"), (i == 0).alias("isHome"), F.when(i != 1, 0.25).alias("xgot")))
    return _flat(payloads.shots(_payload(_done(spark, sf_dir), F.struct(F.col("fixture_id").alias("event_id"), shots.alias("shotmap"))), on_target=True), "home")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'incident' AS entity_type, id || ':index-0' AS source_id, 'goal' AS kind, CAST(home_goals + 1 AS VARCHAR) AS minute FROM d""")
def parse_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents by place where they have no id."""
    body = F.struct(F.col("fixture_id").alias("event_id"), F.array(F.struct(F.lit("goal").alias("incidentType"), (F.col("home_goals") + 1).alias("time"))).alias("incidents"))
    return _flat(payloads.incidents(_payload(_done(spark, sf_dir), body)), "kind", "minute")


@query(f"""{_DONE} SELECT id || ':' || s AS source_id, CASE WHEN s = 'h' THEN home_goals / 4.0 ELSE away_goals / 8.0 END AS xg, CASE WHEN s = 'a' THEN home_goals / 4.0 ELSE away_goals / 8.0 END AS xga, CASE WHEN s = 'h' THEN home_goals + 3 ELSE away_goals + 3 END AS shots FROM d, (SELECT unnest(['h', 'a']) AS s) x""")
def parse_expected_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's embedded data; nested or flat values, a side's against is the other's for; shots where given."""
    h, a = F.col("home_goals") / F.lit(4.0), F.col("away_goals") / F.lit(8.0)
    flat = F.pmod("fixture_id", F.lit(2)) == 0
    body = F.to_json(F.struct("id", F.when(flat, h).alias("h_xg"), F.when(flat, a).alias("a_xg"), F.when(~flat, F.struct(h.alias("h"), a.alias("a"))).alias("xG"), (F.col("home_goals") + 3).alias("h_shot"), (F.col("away_goals") + 3).alias("a_shot")))
    # The page writes its data as a JavaScript string with escaped quotes.
    page = F.concat(F.lit("<html><script>var match_info = JSON.parse('"), F.replace(body, F.lit('"'), F.lit("\\x22")), F.lit("')</script>"))
    pages = _done(spark, sf_dir).select(F.col("id").alias("evidence_id"), page.alias("payload"))
    return payloads.expected_goals(pages).select("source_id", "xg", "xga", "shots")


@query(f"""{_DONE} SELECT ev AS evidence_id, id || ':' || s || ':p' AS source_id, s AS side, CASE WHEN s = 'h' THEN home_goals / 4.0 ELSE away_goals / 8.0 END AS xg FROM d, (SELECT unnest(['h', 'a']) AS s) x""")
def parse_roster_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players as a map by id under each side."""
    side = lambda s, v: F.create_map(F.concat_ws(":", "id", F.lit(s), F.lit("p")), F.struct(F.lit("P").alias("player"), v.cast("string").alias("xG")))
    body = F.struct(F.struct(side("h", F.col("home_goals") / F.lit(4.0)).alias("h"), side("a", F.col("away_goals") / F.lit(8.0)).alias("a")).alias("rosters"))
    return payloads.roster_map(_payload(_done(spark, sf_dir), body)).select("evidence_id", "source_id", "side", "xg")


@query(f"""{_DONE} SELECT ev AS evidence_id, id || ':' || s || ':' || CAST(n.i AS VARCHAR) AS source_id, s AS side, n.i / 8.0 AS xg FROM d, (SELECT unnest(['h', 'a']) AS s) x, (SELECT unnest([1, 2]) AS i) n""")
def parse_side_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots as a list under each side."""
    side = lambda s: F.array(*(F.struct(F.concat_ws(":", "id", F.lit(s), F.lit(str(i))).alias("id"), F.lit(str(i / 8)).alias("xG")) for i in (1, 2)))
    body = F.struct(F.struct(side("h").alias("h"), side("a").alias("a")).alias("shots"))
    return payloads.side_shots(_payload(_done(spark, sf_dir), body)).select("evidence_id", "source_id", "side", "xg")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'fixture' AS entity_type, 'Team ' || h AS home_team, 'Team ' || a AS away_team, CASE fixture_id % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'ambiguous' ELSE 'missing' END AS score_state, CASE WHEN fixture_id % 3 = 0 THEN hg END AS home_goals FROM d
UNION ALL SELECT ev, 'team', NULL, NULL, NULL, NULL FROM d UNION ALL SELECT ev, 'team', NULL, NULL, NULL, NULL FROM d""")
def parse_season_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of a file without ids; only a full-time score is a result."""
    k = F.pmod("fixture_id", F.lit(3))
    both = F.concat_ws(",", F.col("home_goals").cast("string"), F.col("away_goals").cast("string"))
    score = F.when(k == 0, F.concat(F.lit(',"score":{"ft":['), both, F.lit("]}"))).when(k == 1, F.concat(F.lit(',"score":['), both, F.lit("]"))).otherwise("")
    text = F.concat(F.lit('{"name":"L","matches":[{"round":"1","date":"2024-01-01","team1":"Team '), F.col("home_team").cast("string"), F.lit('","team2":"Team '), F.col("away_team").cast("string"), F.lit('"'), score, F.lit("}]}"))
    evidence = _done(spark, sf_dir).select(F.concat(F.lit("ev-"), "id").alias("evidence_id"), text.alias("payload"))
    return _flat(payloads.season_file(evidence), "home_team", "away_team", "score_state", "home_goals").drop("source_id")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'fixture' AS entity_type, id AS source_id, h AS home_team, hg AS home_goals FROM d WHERE fixture_id % 2 = 0 UNION ALL SELECT ev, 'competition', '0', NULL, NULL FROM d WHERE fixture_id % 2 = 0
UNION ALL SELECT ev, 'season', '0:' || season, NULL, NULL FROM d WHERE fixture_id % 2 = 0 UNION ALL SELECT ev, 'team', h, NULL, NULL FROM d WHERE fixture_id % 2 = 0 UNION ALL SELECT ev, 'team', a, NULL, NULL FROM d WHERE fixture_id % 2 = 0""")
def parse_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's events of one league of two."""
    text = lambda c: F.col(c).cast("string")
    event = F.struct(
        F.col("id").alias("idEvent"), F.pmod("fixture_id", F.lit(2)).cast("string").alias("idLeague"), F.lit("League").alias("strLeague"), F.col("season").alias("strSeason"), F.date_format("kickoff_at", "yyyy-MM-dd").alias("dateEvent"), F.date_format("kickoff_at", "HH:mm:ss").alias("strTime"),
        text("home_team").alias("idHomeTeam"), text("away_team").alias("idAwayTeam"), text("home_goals").alias("intHomeScore"), text("away_goals").alias("intAwayScore"), F.lit("FT").alias("strStatus"),
    )
    return _flat(payloads.day_events(_payload(_done(spark, sf_dir), F.struct(F.array(event).alias("events"))), "0"), "home_team", "home_goals")


@query(f"""{_DONE} SELECT ev AS evidence_id, h AS source_id, 'Team ' || h AS name, unnest(['Side ' || h, 'T' || h]) AS alias FROM d""")
def parse_team_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams and their other names, split at commas."""
    team = F.struct(F.col("home_team").cast("string").alias("idTeam"), F.concat(F.lit("Team "), F.col("home_team").cast("string")).alias("strTeam"), F.concat(F.lit("Side "), F.col("home_team").cast("string"), F.lit(", T"), F.col("home_team").cast("string")).alias("strAlternate"))
    return payloads.team_aliases(_payload(_done(spark, sf_dir), F.struct(F.array(team).alias("teams"))))


@query(f"""{_DONE} SELECT ev AS evidence_id, list_filter([CASE WHEN fixture_id % 4 = 0 THEN 'payload' END, CASE WHEN fixture_id % 4 = 1 THEN 'events' END], lambda x: x IS NOT NULL) AS lacks FROM d WHERE fixture_id % 4 < 2""")
def payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: evidence whose payload is no object or lacks what its parser needs."""
    k = F.pmod("fixture_id", F.lit(4))
    text = F.when(k == 0, "{broken").when(k == 1, '{"day":1}').otherwise('{"events":[]}')
    return payloads.drifted(_done(spark, sf_dir).select(F.concat(F.lit("ev-"), "id").alias("evidence_id"), text.alias("payload")), ["events"]).select("evidence_id", "lacks")


@query(f"""{_DONE} SELECT ev AS evidence_id, 'source ' || CAST(n.i AS VARCHAR) AS source, CASE WHEN n.i = 0 THEN 'fixtures' ELSE 'scores' END AS capability, CASE WHEN n.i = 0 THEN home_goals END AS measured, CASE WHEN n.i = 2 THEN 'unknown' ELSE 'measured' END AS state FROM d, (SELECT unnest([0, 1, 2]) AS i) n""")
def qualification_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured and unknown capabilities of several sources as rows, with the defaults of what is above them."""
    body = F.struct(
        F.lit("scores").alias("capability"),
        F.array(F.struct(F.lit("source 0").alias("source"), F.array(F.struct(F.lit("fixtures").alias("capability"), F.col("home_goals").alias("value"))).alias("measured")), F.struct(F.lit("source 1").alias("source"), F.array(F.struct(F.lit(None).cast("string").alias("capability"), F.lit(None).cast("bigint").alias("value"))).alias("measured"))).alias("sources"),
        F.array(F.struct(F.lit("source 2").alias("source"), F.lit("scores").alias("capability"))).alias("unknown_capabilities"),
    )
    return payloads.qualification_rows(_payload(_done(spark, sf_dir), body))
