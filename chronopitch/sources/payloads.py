"""Provider payloads to observations: declared schemas, exploded. One row per entity: entity_type, source_id, name, attributes.

Every parser takes evidence (evidence_id, payload as JSON text, and any other columns) and returns the rows of its
entities with the evidence's columns; payloads that are not of the shape give no rows (`drifted` finds them).
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chronopitch.functions.normalize import content_id, status_family

_TEAM = "struct<id:string,displayName:string>"
SCOREBOARD = (
    "leagues array<struct<id:string,name:string,slug:string,season:struct<year:int,displayName:string>>>,"
    " events array<struct<id:string,name:string,date:string,status:struct<type:struct<name:string,state:string,completed:boolean>>,"
    f" competitions:array<struct<competitors:array<struct<homeAway:string,score:string,team:{_TEAM}>>>>>>"
)
TEAMS = f"sports array<struct<leagues:array<struct<teams:array<struct<team:{_TEAM}>>>>>>"
ATHLETES = "athletes array<struct<id:string,displayName:string,position:struct<name:string>>>"
SUMMARY = (
    "header struct<id:string>, rosters array<struct<team:struct<id:string>,roster:array<struct<starter:boolean,athlete:struct<id:string,displayName:string>,stats:array<struct<name:string,value:double>>>>>>,"
    " boxscore struct<teams:array<struct<team:struct<id:string>,statistics:array<struct<name:string,displayValue:string>>>>>"
)
_SIDE = "struct<id:bigint,name:string>"
_EVENT = (
    f"struct<id:bigint,startTimestamp:bigint,status:struct<code:int,type:string,description:string>,homeTeam:{_SIDE},awayTeam:{_SIDE},homeScore:struct<current:int>,awayScore:struct<current:int>,"
    "tournament:struct<uniqueTournament:struct<id:bigint,name:string>>,season:struct<id:bigint,name:string>,roundInfo:struct<round:int>,changes:struct<changeTimestamp:bigint>>"
)
DETAIL = f"event {_EVENT}, events array<{_EVENT}>"
_PLAYERS = "struct<players:array<struct<player:struct<id:bigint,name:string>,teamId:bigint,substitute:boolean,position:string,statistics:map<string,string>>>>"
LINEUPS = f"event_id bigint, home {_PLAYERS}, away {_PLAYERS}"
STATISTICS = "event_id bigint, statistics array<struct<period:string,groups:array<struct<statisticsItems:array<struct<key:string,name:string,home:string,away:string>>>>>>"
SHOTS = "event_id bigint, shotmap array<struct<id:bigint,player:struct<id:bigint,name:string>,isHome:boolean,xg:double,xgot:double,time:int>>"
INCIDENTS = "event_id bigint, incidents array<struct<id:bigint,incidentType:string,time:int,isHome:boolean>>"
SEASON_FILE = "name string, matches array<struct<round:string,date:string,time:string,team1:string,team2:string,score:string>>"
DAY = "events array<struct<idEvent:string,idLeague:string,strLeague:string,strSeason:string,dateEvent:string,strTime:string,idHomeTeam:string,idAwayTeam:string,strHomeTeam:string,strAwayTeam:string,intHomeScore:string,intAwayScore:string,strStatus:string>>"


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value)


def entity(kind: str, source_id: Column, name: Column | None = None, /, **attributes: Column) -> Column:
    """One observation; attributes that are null are left out."""
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), _text(v).alias("value")) for k, v in attributes.items())) if attributes else F.array().cast("array<struct<key:string,value:string>>")
    kept = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return F.struct(F.lit(kind).alias("entity_type"), source_id.cast("string").alias("source_id"), (F.lit(None).cast("string") if name is None else name.cast("string")).alias("name"), kept.alias("attributes"))


def _read(evidence: DataFrame, schema: str) -> tuple[DataFrame, list[str]]:
    kept = [c for c in evidence.columns if c != "payload"]
    return evidence.select(*kept, F.from_json("payload", schema).alias("_p")), kept


def _emit(rows: DataFrame, kept: list[str], *entities: Column) -> DataFrame:
    out = rows.select(*kept, F.explode(F.array_compact(F.array(*entities))).alias("o")).select(*kept, "o.*")
    return out.where("source_id IS NOT NULL")


def scoreboard(evidence: DataFrame) -> DataFrame:
    """Competitions, seasons, fixtures and their teams. A fixture needs an id and a date; sides go by homeAway."""
    rows, kept = _read(evidence, SCOREBOARD)
    league = rows.select(*kept, F.explode("_p.leagues").alias("l"))
    first = _emit(league, kept, entity("competition", F.col("l.id"), F.col("l.name"), slug=F.col("l.slug")), F.when(F.col("l.season.year").isNotNull(), entity("season", F.concat_ws(":", "l.id", F.col("l.season.year").cast("string")), F.col("l.season.displayName"))))
    e = rows.select(*kept, F.explode("_p.events").alias("e")).where("e.id IS NOT NULL AND e.date IS NOT NULL")
    side = lambda w: F.get(F.filter(F.get("e.competitions", 0)["competitors"], lambda c: c["homeAway"] == w), 0)
    e = e.withColumns({"h": side("home"), "a": side("away")})
    fixture = entity("fixture", F.col("e.id"), F.col("e.name"), kickoff_at=F.try_to_timestamp("e.date"), status=status_family(F.col("e.status.type.name")), home_team=F.col("h.team.id"), away_team=F.col("a.team.id"), home_goals=F.col("h.score").try_cast("int"), away_goals=F.col("a.score").try_cast("int"))
    second = _emit(e, kept, fixture, *(F.when(F.col(f"{s}.team.id").isNotNull(), entity("team", F.col(f"{s}.team.id"), F.col(f"{s}.team.displayName"))) for s in "ha"))
    return first.unionByName(second)


def teams(evidence: DataFrame) -> DataFrame:
    rows, kept = _read(evidence, TEAMS)
    t = rows.select(*kept, F.explode("_p.sports").alias("s")).select(*kept, F.explode("s.leagues").alias("l")).select(*kept, F.explode("l.teams").alias("t"))
    return _emit(t, kept, entity("team", F.col("t.team.id"), F.col("t.team.displayName")))


def athletes(evidence: DataFrame) -> DataFrame:
    rows, kept = _read(evidence, ATHLETES)
    return _emit(rows.select(*kept, F.explode("_p.athletes").alias("a")), kept, entity("player", F.col("a.id"), F.col("a.displayName"), position=F.col("a.position.name")))


def summary(evidence: DataFrame) -> DataFrame:
    """Line-ups and player statistics as event:team:player, team statistics as event:team."""
    rows, kept = _read(evidence, SUMMARY)
    r = rows.select(*kept, F.col("_p.header.id").alias("event"), F.explode("_p.rosters").alias("t")).select(*kept, "event", F.col("t.team.id").alias("team"), F.explode("t.roster").alias("p"))
    key = F.concat_ws(":", "event", "team", "p.athlete.id")
    stats = F.map_from_entries(F.transform("p.stats", lambda s: F.struct(s["name"], s["value"].cast("string"))))
    players = _emit(r, kept, entity("lineup", key, F.col("p.athlete.displayName"), starter=F.col("p.starter")), F.when(F.size("p.stats") > 0, F.struct(F.lit("player_stat").alias("entity_type"), key.alias("source_id"), F.col("p.athlete.displayName").alias("name"), stats.alias("attributes"))))
    b = rows.select(*kept, F.col("_p.header.id").alias("event"), F.explode("_p.boxscore.teams").alias("t"))
    own = F.map_from_entries(F.transform("t.statistics", lambda s: F.struct(s["name"], s["displayValue"])))
    return players.unionByName(_emit(b, kept, F.struct(F.lit("team_stat").alias("entity_type"), F.concat_ws(":", "event", "t.team.id").alias("source_id"), F.lit(None).cast("string").alias("name"), own.alias("attributes"))))


def detail(evidence: DataFrame) -> DataFrame:
    """One event or a list of them: competition, season, fixture and teams."""
    rows, kept = _read(evidence, DETAIL)
    e = rows.select(*kept, F.explode(F.coalesce("_p.events", F.when(F.col("_p.event").isNotNull(), F.array("_p.event")))).alias("e")).where("e.id IS NOT NULL")
    moved = F.timestamp_seconds("e.changes.changeTimestamp")
    fixture = entity("fixture", F.col("e.id"), kickoff_at=F.timestamp_seconds("e.startTimestamp"), status=status_family(F.col("e.status.type")), home_team=F.col("e.homeTeam.id"), away_team=F.col("e.awayTeam.id"), home_goals=F.col("e.homeScore.current"), away_goals=F.col("e.awayScore.current"), round=F.col("e.roundInfo.round"), updated_at=moved)
    some = lambda path, made: F.when(F.col(path).isNotNull(), made)
    return _emit(e, kept, fixture, some("e.tournament.uniqueTournament.id", entity("competition", F.col("e.tournament.uniqueTournament.id"), F.col("e.tournament.uniqueTournament.name"))), some("e.season.id", entity("season", F.col("e.season.id"), F.col("e.season.name"))), *(some(f"e.{s}Team.id", entity("team", F.col(f"e.{s}Team.id"), F.col(f"e.{s}Team.name"))) for s in ("home", "away")))


def lineups(evidence: DataFrame) -> DataFrame:
    """Both sides' players; a starter is no substitute; player statistics where there are any."""
    rows, kept = _read(evidence, LINEUPS)
    sides = F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"_p.{s}.players").alias("players")) for s in ("home", "away")))
    p = rows.select(*kept, F.col("_p.event_id").alias("event"), F.explode(sides).alias("s")).select(*kept, "event", "s.side", F.explode("s.players").alias("p"))
    key = F.concat_ws(":", F.col("event").cast("string"), F.col("p.teamId").cast("string"), F.col("p.player.id").cast("string"))
    stat = F.when(F.size("p.statistics") > 0, F.struct(F.lit("player_stat").alias("entity_type"), key.alias("source_id"), F.col("p.player.name").alias("name"), F.col("p.statistics").alias("attributes")))
    return _emit(p, kept, entity("lineup", key, F.col("p.player.name"), side=F.col("side"), starter=~F.coalesce("p.substitute", F.lit(False)), position=F.col("p.position")), stat)


def team_statistics(evidence: DataFrame) -> DataFrame:
    """The whole match's statistics, or the first period's where there is no whole: a row per side."""
    rows, kept = _read(evidence, STATISTICS)
    whole = F.coalesce(F.get(F.filter("_p.statistics", lambda s: s["period"] == "ALL"), 0), F.get("_p.statistics", 0))
    rows = rows.select(*kept, F.col("_p.event_id").alias("event"), F.flatten(F.transform(whole["groups"], lambda g: g["statisticsItems"])).alias("items")).where("items IS NOT NULL")
    own = lambda side: F.map_from_entries(F.transform("items", lambda i: F.struct(F.coalesce(i["key"], i["name"]), i[side])))
    made = lambda side: F.struct(F.lit("team_stat").alias("entity_type"), F.concat_ws(":", F.col("event").cast("string"), F.lit(side)).alias("source_id"), F.lit(None).cast("string").alias("name"), own(side).alias("attributes"))
    return _emit(rows, kept, made("home"), made("away"))


def shots(evidence: DataFrame, on_target: bool = False) -> DataFrame:
    """Shots by event and id, or place where there is no id; on target are those with a value after the shot."""
    rows, kept = _read(evidence, SHOTS)
    s = rows.select(*kept, F.col("_p.event_id").alias("event"), F.posexplode("_p.shotmap").alias("n", "s"))
    s = s.where("s.xgot IS NOT NULL") if on_target else s
    key = F.concat_ws(":", F.col("event").cast("string"), F.coalesce(F.col("s.id").cast("string"), F.format_string("index-%d", "n")))
    return _emit(s, kept, entity("shot", key, F.col("s.player.name"), home=F.col("s.isHome"), xg=F.col("s.xg"), xgot=F.col("s.xgot"), minute=F.col("s.time")))


def incidents(evidence: DataFrame) -> DataFrame:
    rows, kept = _read(evidence, INCIDENTS)
    i = rows.select(*kept, F.col("_p.event_id").alias("event"), F.posexplode("_p.incidents").alias("n", "i"))
    key = F.concat_ws(":", F.col("event").cast("string"), F.coalesce(F.col("i.id").cast("string"), F.format_string("index-%d", "n")))
    return _emit(i, kept, entity("incident", key, None, kind=F.col("i.incidentType"), minute=F.col("i.time"), home=F.col("i.isHome")))


def season_file(evidence: DataFrame) -> DataFrame:
    """Matches of a file that has no ids: keys by date and names; a bare score is ambiguous, not a result."""
    rows, kept = _read(evidence, SEASON_FILE)
    m = rows.select(*kept, F.explode("_p.matches").alias("m")).where("m.date IS NOT NULL AND m.team1 IS NOT NULL AND m.team2 IS NOT NULL")
    full = F.from_json(F.get_json_object("m.score", "$.ft"), "array<int>")
    state = F.when(F.col("m.score").isNull(), "missing").when(F.size(full) == 2, "confirmed").when(F.col("m.score").startswith("["), "ambiguous").otherwise("malformed")
    fixture = entity("fixture", content_id("of-", F.col("m.date"), F.col("m.team1"), F.col("m.team2"), length=24), None, date=F.col("m.date"), time=F.col("m.time"), home_team=F.col("m.team1"), away_team=F.col("m.team2"), round=F.col("m.round"), score_state=state, home_goals=F.get(full, 0), away_goals=F.get(full, 1))
    return _emit(m, kept, fixture, *(entity("team", F.col(f"m.{t}"), F.col(f"m.{t}")) for t in ("team1", "team2")))


def day_events(evidence: DataFrame, league: str | None = None) -> DataFrame:
    """A day's or a league's events: competition, season as league:season, fixture, teams."""
    rows, kept = _read(evidence, DAY)
    e = rows.select(*kept, F.explode("_p.events").alias("e")).where("e.idEvent IS NOT NULL")
    e = e if league is None else e.where(F.col("e.idLeague") == league)
    at = F.try_to_timestamp(F.concat_ws(" ", "e.dateEvent", F.substring(F.coalesce("e.strTime", F.lit("00:00:00")), 1, 8)))
    score = lambda c: F.col(c).try_cast("int")
    done = score("e.intHomeScore").isNotNull() & score("e.intAwayScore").isNotNull() & status_family(F.col("e.strStatus")).isin("finished", "unknown")
    fixture = entity("fixture", F.col("e.idEvent"), None, kickoff_at=at, status=F.when(done, "finished").otherwise(status_family(F.col("e.strStatus"))), home_team=F.col("e.idHomeTeam"), away_team=F.col("e.idAwayTeam"), home_goals=score("e.intHomeScore"), away_goals=score("e.intAwayScore"))
    return _emit(e, kept, fixture, entity("competition", F.col("e.idLeague"), F.col("e.strLeague")), entity("season", F.concat_ws(":", "e.idLeague", "e.strSeason")), entity("team", F.col("e.idHomeTeam"), F.col("e.strHomeTeam")), entity("team", F.col("e.idAwayTeam"), F.col("e.strAwayTeam")))


@F.pandas_udf(StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    """A JavaScript string's content: hex, unicode and single-letter escapes."""
    letters = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}

    def one(m: re.Match) -> str:
        s = m[1]
        return chr(int(s[1:], 16)) if s[0] in "xu" and len(s) > 1 else letters.get(s, s)

    def whole(t: str | None) -> str | None:
        if not t:
            return None
        out = re.sub(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|.)", one, t, flags=re.S)
        try:
            json.loads(out)
        except ValueError:
            return None
        return out

    return text.map(whole)


def embedded_json(pages: DataFrame, name: str, html: str = "payload") -> DataFrame:
    """The pages with `embedded`, the JSON that a page assigns to `name` through JSON.parse; null where there is none."""
    raw = F.regexp_extract(html, rf"\b{re.escape(name)}\s*=\s*JSON\.parse\('((?:[^'\\]|\\.)*)'\)", 1)
    return pages.withColumn("embedded", _unescaped(raw))


def expected_goals(pages: DataFrame, html: str = "payload") -> DataFrame:
    """Team rows of a page's match_info: nested xG {h, a} or flat h_xg and a_xg; a side's against is the other's for."""
    rows = embedded_json(pages, "match_info", html).withColumn("v", F.try_parse_json("embedded")).where("v IS NOT NULL")
    get = lambda path, kind="double": F.try_variant_get("v", path, kind)
    home, away = F.coalesce(get("$.xG.h"), get("$.h_xg")), F.coalesce(get("$.xG.a"), get("$.a_xg"))
    kept = [c for c in pages.columns if c != html]
    count = lambda *paths: F.coalesce(*(get(p, "bigint") for p in paths))
    shots = {"h": count("$.shots.h", "$.h_shot"), "a": count("$.shots.a", "$.a_shot")}
    sides = F.array(*(F.struct(F.lit(s).alias("side"), own.alias("xg"), other.alias("xga"), shots[s].alias("shots")) for s, own, other in (("h", home, away), ("a", away, home))))
    return rows.select(*kept, get("$.id", "string").alias("event"), F.explode(sides).alias("s")).select(*kept, F.concat_ws(":", "event", "s.side").alias("source_id"), "s.xg", "s.xga", "s.shots")


def _by_side(evidence: DataFrame, member: str, kind: str) -> DataFrame:
    rows, kept = _read(evidence, f"{member} struct<h:{kind},a:{kind}>")
    sides = F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"_p.{member}.{s}").alias("held")) for s in "ha"))
    return rows.select(*kept, F.explode(sides).alias("s")).select(*kept, "s.side", "s.held")


def roster_map(evidence: DataFrame) -> DataFrame:
    """Players of both sides from a map by id: source_id, side, name, xg."""
    kept = [c for c in evidence.columns if c != "payload"]
    rows = _by_side(evidence, "rosters", "map<string,struct<player:string,xG:string>>")
    return rows.select(*kept, "side", F.explode("held").alias("source_id", "p")).select(*kept, "source_id", "side", F.col("p.player").alias("name"), F.col("p.xG").try_cast("double").alias("xg"))


def side_shots(evidence: DataFrame) -> DataFrame:
    """Shots of both sides from a list each: source_id, side, xg."""
    kept = [c for c in evidence.columns if c != "payload"]
    rows = _by_side(evidence, "shots", "array<struct<id:string,xG:string>>")
    return rows.select(*kept, "side", F.explode("held").alias("p")).select(*kept, F.col("p.id").alias("source_id"), "side", F.col("p.xG").try_cast("double").alias("xg"))


def team_aliases(evidence: DataFrame) -> DataFrame:
    """Teams with each of their other names, which the source writes with commas between."""
    rows, kept = _read(evidence, "teams array<struct<idTeam:string,strTeam:string,strAlternate:string>>")
    t = rows.select(*kept, F.explode("_p.teams").alias("t")).where("t.idTeam IS NOT NULL")
    names = F.filter(F.transform(F.split("t.strAlternate", ","), lambda n: F.trim(n)), lambda n: n != "")
    return t.select(*kept, F.col("t.idTeam").alias("source_id"), F.col("t.strTeam").alias("name"), F.explode(names).alias("alias"))


def qualification_rows(evidence: DataFrame) -> DataFrame:
    """A qualification report's measured and unknown capabilities as rows; a measure without a capability has the report's."""
    rows, kept = _read(evidence, "capability string, sources array<struct<source:string,measured:array<struct<capability:string,value:bigint>>>>, unknown_capabilities array<struct<source:string,capability:string>>")
    m = rows.select(*kept, F.col("_p.capability").alias("default"), F.explode("_p.sources").alias("s")).select(*kept, "default", F.col("s.source").alias("source"), F.explode("s.measured").alias("m"))
    m = m.select(*kept, "source", F.coalesce("m.capability", "default").alias("capability"), F.col("m.value").alias("measured"), F.lit("measured").alias("state"))
    u = rows.select(*kept, F.explode("_p.unknown_capabilities").alias("u")).select(*kept, "u.source", "u.capability", F.lit("unknown").alias("state"))
    return m.unionByName(u, allowMissingColumns=True)


def drifted(evidence: DataFrame, required: list[str]) -> DataFrame:
    """Evidence whose payload is no JSON object or lacks a required member, with what it lacks."""
    v = F.try_parse_json("payload")
    lacks = F.array_compact(F.array(*(F.when(F.try_variant_get(v, f"$.{m}", "variant").isNull(), F.lit(m)) for m in required)))
    return evidence.withColumn("lacks", F.when(v.isNull(), F.array(F.lit("payload"))).otherwise(lacks)).where(F.size("lacks") > 0)
