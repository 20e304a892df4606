import json

from pyspark.sql import functions as F

from chronopitch.operators import pit, sinks
from chronopitch.sources import landed, payloads


def evidence(spark, *objects):
    return spark.createDataFrame([(f"ev{i}", o if isinstance(o, str) or o is None else json.dumps(o)) for i, o in enumerate(objects)], "evidence_id string, payload string")


def entities(df):
    return {(r["entity_type"], r["source_id"]): r for r in df.collect()}


def test_scoreboard(spark):
    event = {"id": "7", "name": "A v B", "date": "2025-01-15T20:00Z", "status": {"type": {"name": "STATUS_FINAL"}}, "competitions": [{"competitors": [{"homeAway": "away", "score": "1", "team": {"id": "b", "displayName": "B"}}, {"homeAway": "home", "score": "2", "team": {"id": "a", "displayName": "A"}}]}]}
    doc = {"leagues": [{"id": "9", "name": "L", "season": {"year": 2024, "displayName": "2024-25"}}], "events": [event, {"id": "8"}]}
    got = entities(payloads.scoreboard(evidence(spark, doc, {"events": []}, None, "{bad")))
    assert set(got) == {("competition", "9"), ("season", "9:2024"), ("fixture", "7"), ("team", "a"), ("team", "b")}
    assert got["fixture", "7"]["attributes"]["home_goals"] == "2" and got["fixture", "7"]["attributes"]["status"] == "finished"


def test_details_lineups_statistics_and_shots(spark):
    e = {"id": 1, "startTimestamp": 1736971200, "status": {"type": "finished"}, "homeTeam": {"id": 5, "name": "H"}, "awayTeam": {"id": 6, "name": "A"}, "homeScore": {"current": 3}, "awayScore": {"current": 0}, "season": {"id": 2, "name": "S"}}
    assert entities(payloads.detail(evidence(spark, {"event": e}, {"events": [e | {"id": 4}]})))["fixture", "4"]["attributes"]["home_goals"] == "3"
    player = {"player": {"id": 3, "name": "P"}, "teamId": 5, "substitute": False, "statistics": {"goals": 1}}
    got = entities(payloads.lineups(evidence(spark, {"event_id": 1, "home": {"players": [player]}, "away": {"players": [player | {"statistics": {}, "teamId": 6}]}})))
    assert set(got) == {("lineup", "1:5:3"), ("player_stat", "1:5:3"), ("lineup", "1:6:3")}
    groups = [{"statisticsItems": [{"key": "shots", "home": "9", "away": "4"}]}]
    got = entities(payloads.team_statistics(evidence(spark, {"event_id": 1, "statistics": [{"period": "1ST", "groups": []}, {"period": "ALL", "groups": groups}]})))
    assert got["team_stat", "1:away"]["attributes"] == {"shots": "4"}
    shots = {"event_id": 1, "shotmap": [{"id": 11, "xg": 0.1, "xgot": 0.3}, {"xg": 0.2}]}
    assert set(entities(payloads.shots(evidence(spark, shots)))) == {("shot", "1:11"), ("shot", "1:index-1")}
    assert payloads.shots(evidence(spark, shots), on_target=True).count() == 1


def test_files_without_ids_and_days(spark):
    doc = {"matches": [{"date": "2025-01-15", "team1": "A", "team2": "B", "score": {"ft": [1, 2]}}, {"date": "2025-01-16", "team1": "A", "team2": "C", "score": [0, 0]}, {"team1": "A"}]}
    states = {r["attributes"]["score_state"] for r in payloads.season_file(evidence(spark, doc)).where("entity_type = 'fixture'").collect()}
    assert states == {"confirmed", "ambiguous"}
    day = {"events": [{"idEvent": "1", "idLeague": "4", "strSeason": "2024-2025", "dateEvent": "2025-01-15", "strTime": "20:00:00", "idHomeTeam": "h", "idAwayTeam": "a", "intHomeScore": "1", "intAwayScore": "1", "strStatus": "Match Finished"}, {"idEvent": "2", "idLeague": "5"}]}
    got = entities(payloads.day_events(evidence(spark, day), league="4"))
    assert ("season", "4:2024-2025") in got and got["fixture", "1"]["attributes"]["status"] == "finished" and ("fixture", "2") not in got


def test_embedded_json(spark):
    page = r"<script>var match_info = JSON.parse('\x7B\x22id\x22\x3A\x22m1\x22,\x22h_xg\x22:1.5,\x22a_xg\x22:\x220.7\x22\x7D')</script>"
    rows = {r["source_id"]: (r["xg"], r["xga"]) for r in payloads.expected_goals(evidence(spark, page, "no script", None)).collect()}
    assert rows == {"m1:h": (1.5, 0.7), "m1:a": (0.7, 1.5)}


def test_drifted_payloads(spark):
    got = {r["evidence_id"]: r["lacks"] for r in payloads.drifted(evidence(spark, {"a": 1}, {"b": 1}, "{bad"), ["a"]).collect()}
    assert got == {"ev1": ["a"], "ev2": ["payload"]}


def test_season_files(spark, tmp_path):
    lines = ["Date,Time,HomeTeam,AwayTeam,FTHG,FTAG", "15/01/2025,20:00,A,B,2,1", "30/03/2025,16:00,B,A,,", "30/03/2025,01:30,C,A,1,1", "26/10/2024,16:00,A,C,0,0", "26/10/2024,17:00,A,C,,", "soon,15:00,A,D,,"]
    (tmp_path / "2425-E0.csv").write_text("\n".join(lines), encoding="latin-1")
    fixtures, bad = landed.season_results(spark, str(tmp_path))
    got = {r["fixture_id"]: (str(r["kickoff_at"]), r["home_goals"]) for r in fixtures.collect()}
    assert got["fixture:epl:2024/25:a:b"] == ("2025-01-15 20:00:00", 2) and got["fixture:epl:2024/25:b:a"] == ("2025-03-30 15:00:00", None) and got["fixture:epl:2024/25:a:c"][1] == 0
    assert {r["reason"] for r in bad.collect()} == {"nonexistent_time", "unreadable_date"}


def test_landed_payloads(spark, tmp_path):
    (tmp_path / "src" / "lineups").mkdir(parents=True)
    (tmp_path / "src" / "lineups" / "a.json").write_text('{"x": 1}')
    spark.dataSource.register(landed.LandedPayloads)
    row = spark.read.format("landed_payloads").load(str(tmp_path)).collect()[0]
    assert (row["source"], row["capability"], row["payload"]) == ("src", "lineups", '{"x": 1}')
    assert landed.evidence(spark, str(tmp_path / "src" / "lineups")).count() == 1


def test_a_replay_is_a_no_op_and_a_conflict_fails(spark):
    old = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    assert sinks.checked_append(old, old, "k", ["v"]).count() == 0
    new = spark.createDataFrame([("a", 1), ("c", 3), ("c", 3)], "k string, v int")
    assert [r["k"] for r in sinks.checked_append(old, new, "k", ["v"]).collect()] == ["c"]
    try:
        sinks.checked_append(old, spark.createDataFrame([("b", 2)], "k string, v int"), "k", ["v"]).collect()
    except Exception as e:  # noqa: BLE001
        assert "conflicting replay of b" in str(e)
    else:
        raise AssertionError("a conflict passed")


def test_future_rows_change_no_past_form(spark, data):
    from chronopitch.plans.domain import matches

    m = matches(spark, data)
    cut = m.selectExpr("percentile_approx(kickoff_at, 0.5) c").head()["c"]
    past = lambda df: sorted(map(str, pit.snapshot(df).where(F.col("kickoff_at") < F.lit(cut)).collect()))
    assert past(m) == past(m.where(F.col("kickoff_at") < F.lit(cut)))
