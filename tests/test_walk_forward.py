"""The walk-forward comparison against plain refits at every cut-off."""

import math

from chronopitch.operators import pit, ratings
from chronopitch.plans import model_queries as M
from chronopitch.plans.domain import matches


def outcome(grid):
    whole = sum(map(sum, grid))
    return tuple(sum(p for h, row in enumerate(grid) for a, p in enumerate(row) if test(h, a)) / whole for test in (lambda h, a: h > a, lambda h, a: h == a))


def poisson(home, away):
    return [[math.exp(-home - away) * home**h * away**a / math.factorial(h) / math.factorial(a) for a in range(11)] for h in range(11)]


def refit(train, row, form):
    hm, am = (max(0.05, sum(r[g] for r in train) / len(train) or rest) for g, rest in (("home_goals", 1.3), ("away_goals", 1.1)))
    counts = [[0.5] * 11 for _ in range(11)]
    rated = {}
    for r in train:
        counts[min(r["home_goals"], 10)][min(r["away_goals"], 10)] += 1
        x, y = rated.get(r["home_team"], 1500.0), rated.get(r["away_team"], 1500.0)
        won = 1.0 if r["home_goals"] > r["away_goals"] else 0.5 if r["home_goals"] == r["away_goals"] else 0.0
        delta = 20 * (won - 1 / (1 + 10 ** (-(x + 60 - y) / 400)))
        rated[r["home_team"]], rated[r["away_team"]] = x + delta, y - delta
    edge = math.tanh((rated.get(row["home_team"], 1500.0) + 60 - rated.get(row["away_team"], 1500.0)) / 400)
    num = lambda name, rest: rest if form[name] is None else form[name]
    grid = poisson(max(0.05, (num("home_goals_for_avg", hm) + num("away_goals_against_avg", hm)) / 2), max(0.05, (num("away_goals_for_avg", am) + num("home_goals_against_avg", am)) / 2))
    x, y = num("home_goals_for_avg", hm) or hm, num("away_goals_for_avg", am) or am
    low = [list(r) for r in grid]
    for (h, a), f in {(0, 0): 1 + 0.1 * x * y, (0, 1): 1 - 0.1 * x, (1, 0): 1 - 0.1 * y, (1, 1): 1.1}.items():
        low[h][a] = max(0.0, low[h][a] * f)
    return {"frequency": outcome(counts), "poisson": outcome(grid), "elo": outcome(poisson(max(0.05, hm * (1 + 0.35 * edge)), max(0.05, am * (1 - 0.25 * edge)))), "dixon_coles": outcome(low)}


def test_models_are_refit_before_each_cut_off(spark, data):
    played = sorted(matches(spark, data).where("status = 'completed'").collect(), key=lambda r: (r["kickoff_at"], r["fixture_id"]))
    form = {r["fixture_id"]: r for r in pit.snapshot(matches(spark, data)).collect()}
    got = {(r["fixture_id"], r["model"]): (r["p_home"], r["p_draw"]) for r in M._walk_forward(spark, data).collect()}
    want = {}
    for row in played:
        train = [r for r in played if r["competition"] == row["competition"] and r["kickoff_at"] < row["kickoff_at"]]
        if len(train) >= 100:
            want |= {(row["fixture_id"], m): p for m, p in refit(train, row, form[row["fixture_id"]]).items()}
    assert want and got.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k, p in want.items() for x, y in zip(p, got[k]))


def test_the_comparison_ranks_four_models_and_selects_one(spark, data):
    rows = M.walk_forward_selection(spark, data).collect()
    assert {r["model"] for r in rows} == {"frequency", "poisson", "elo", "dixon_coles"} and sum(r["selected"] for r in rows) == 1


def test_ratings_strictly_before_the_kick_off(spark):
    rows = spark.createDataFrame([("l", i, t, "a", b, 1, 0) for i, t, b in ((1, "2024-01-01", "b"), (2, "2024-01-01", "c"), (3, "2024-01-02", "b"))], "competition string, fixture_id long, kickoff_at string, home_team string, away_team string, home_goals int, away_goals int").selectExpr("*", "CAST(kickoff_at AS timestamp_ntz) AS k").drop("kickoff_at").withColumnRenamed("k", "kickoff_at")
    strict, line = ({r["fixture_id"]: r for r in ratings.elo(rows, strictly=s).collect()} for s in (True, False))
    assert strict[2]["home_before"] == 1500.0 < line[2]["home_before"] and strict[3]["home_before"] == line[3]["home_before"] == line[2]["home_after"]
