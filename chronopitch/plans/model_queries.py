"""Score models, derived markets, ratings, evaluation and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import probability as P
from chronopitch.operators import evaluation as E
from chronopitch.operators import pit, ratings
from chronopitch.plans.domain import MATCHES, TEAM_ROWS, matches
from chronopitch.session import cut

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


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each completed match with its Poisson rates and attack averages, from the form before it."""
    m = matches(spark, sf_dir).where("status = 'completed'").select("fixture_id", "home_goals", "away_goals", "season", "kickoff_at", "home_team", "away_team", "competition")
    f = pit.snapshot(matches(spark, sf_dir)).drop("kickoff_at")
    c = F.col
    home, away = P.poisson_rates(c("home_goals_for_avg"), c("away_goals_against_avg"), c("away_goals_for_avg"), c("home_goals_against_avg"), F.lit(1.3), F.lit(1.1))
    attack = lambda name, rest: F.coalesce(F.nullif(P.usable(c(name), rest), F.lit(0.0)), F.lit(rest))
    actual = F.when(c("home_goals") > c("away_goals"), 0).when(c("home_goals") == c("away_goals"), 1).otherwise(2)
    rows = m.join(f, "fixture_id").withColumns({"home_rate": home, "away_rate": away, "home_attack": attack("home_goals_for_avg", 1.3), "away_attack": attack("away_goals_for_avg", 1.1), "actual": actual})
    return rows.select(*m.columns, "home_rate", "away_rate", "home_attack", "away_attack", "actual")


class _Lines(tuple):
    """Column names that become columns when they are used: there is no session at import."""

    def __iter__(self):
        return (F.col(c) for c in tuple.__iter__(self))


LINES = _Lines(("home_line", "away_line"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates with a normalised line of goal probabilities per side; the product of both is the score grid."""
    rows = _rates(spark, sf_dir).withColumns({"_h": P.poisson_line(F.col("home_rate")), "_a": P.poisson_line(F.col("away_rate"))})
    return rows.withColumns({"home_line": P.normalised(F.col("_h")), "away_line": P.normalised(F.col("_a"))}).drop("_h", "_a")


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumns({"p_home": P.home_win(*LINES), "p_draw": P.draw(*LINES)})
    return rows.withColumn("p_away", P.away_win(F.col("p_home"), F.col("p_draw"))).withColumn("score_p", P.score_probability(*LINES, F.col("home_goals"), F.col("away_goals")))


RATES = f"""{MATCHES}, {TEAM_ROWS},
w5 AS (SELECT fixture_id, is_home, avg(gf) OVER w AS gf, avg(ga) OVER w AS ga FROM team_rows WINDOW w AS (PARTITION BY team ORDER BY kickoff_at, fixture_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
rates AS (SELECT m.*, greatest(0.05, (coalesce(h.gf, 1.3) + coalesce(a.ga, 1.3)) / 2.0) AS home_rate, greatest(0.05, (coalesce(a.gf, 1.1) + coalesce(h.ga, 1.1)) / 2.0) AS away_rate,
    coalesce(nullif(coalesce(h.gf, 1.3), 0.0), 1.3) AS home_attack, coalesce(nullif(coalesce(a.gf, 1.1), 0.0), 1.1) AS away_attack,
    CASE WHEN home_goals > away_goals THEN 0 WHEN home_goals = away_goals THEN 1 ELSE 2 END AS actual
  FROM matches m JOIN w5 h ON h.fixture_id = m.fixture_id AND h.is_home JOIN w5 a ON a.fixture_id = m.fixture_id AND NOT a.is_home WHERE m.status = 'completed')"""
GRID = """raw AS (SELECT fixture_id, h, a, exp(-home_rate) * pow(home_rate, h) / CAST(factorial(CAST(h AS INTEGER)) AS DOUBLE) * exp(-away_rate) * pow(away_rate, a) / CAST(factorial(CAST(a AS INTEGER)) AS DOUBLE) AS p FROM rates, range(0, 11) AS x(h), range(0, 11) AS y(a)),
grid AS (SELECT fixture_id, h, a, p / sum(p) OVER (PARTITION BY fixture_id) AS p FROM raw)"""
FORECASTS = f"""{RATES}, {GRID},
pr AS (SELECT fixture_id, sum(CASE WHEN h > a THEN p ELSE 0 END) AS p_home, sum(CASE WHEN h = a THEN p ELSE 0 END) AS p_draw FROM grid GROUP BY fixture_id),
fc AS (SELECT r.*, p_home, p_draw, greatest(0.0, 1.0 - p_home - p_draw) AS p_away FROM rates r JOIN pr ON pr.fixture_id = r.fixture_id),
sc AS (SELECT *, greatest(p_home, p_draw, p_away) AS sharpness, CASE WHEN round(p_home, 9) = greatest(round(p_home, 9), round(p_draw, 9), round(p_away, 9)) THEN 0 WHEN round(p_draw, 9) = greatest(round(p_home, 9), round(p_draw, 9), round(p_away, 9)) THEN 1 ELSE 2 END = actual AS hit,
  -ln(least(1.0, greatest(1e-15, CASE actual WHEN 0 THEN p_home WHEN 1 THEN p_draw ELSE p_away END))) AS log_loss,
  pow(p_home - CAST(actual = 0 AS INTEGER), 2) + pow(p_draw - CAST(actual = 1 AS INTEGER), 2) + pow(p_away - CAST(actual = 2 AS INTEGER), 2) AS brier_score,
  (pow(p_home - CAST(actual = 0 AS INTEGER), 2) + pow(p_home + p_draw - CAST(actual <= 1 AS INTEGER), 2)) / 2.0 AS rps FROM fc)"""


@query(f"""WITH {RATES}, {GRID} SELECT g.fixture_id, round(sum(CASE WHEN h > a THEN p ELSE 0 END), 6) AS home, round(sum(CASE WHEN h = a THEN p ELSE 0 END), 6) AS draw, round(greatest(0.0, 1.0 - sum(CASE WHEN h > a THEN p ELSE 0 END) - sum(CASE WHEN h = a THEN p ELSE 0 END)), 6) AS away,
  round(sum(CASE WHEN h > 0 AND a > 0 THEN p ELSE 0 END), 6) AS btts, round(sum(CASE WHEN h + a > 0.5 THEN p ELSE 0 END), 6) AS over_05, round(sum(CASE WHEN h + a > 2.5 THEN p ELSE 0 END), 6) AS over_25, round(1.0 - sum(CASE WHEN h + a > 2.5 THEN p ELSE 0 END), 6) AS under_25, round(sum(CASE WHEN h + a > 4.5 THEN p ELSE 0 END), 6) AS over_45,
  round(sum(CASE WHEN h = r.home_goals AND a = r.away_goals THEN p ELSE 0 END), 6) AS exact_score FROM grid g JOIN rates r ON r.fixture_id = g.fixture_id GROUP BY g.fixture_id""")
def poisson_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 M2 M3 M4 M5 M8: outcome, both score, over and under, exact score."""
    rows = _lines(spark, sf_dir).select(
        "fixture_id", P.home_win(*LINES).alias("home"), P.draw(*LINES).alias("draw"), P.both_score(*LINES).alias("btts"), P.over(*LINES, 0.5).alias("over_05"), P.over(*LINES, 2.5).alias("over_25"),
        P.over(*LINES, 4.5).alias("over_45"), P.score_probability(*LINES, F.col("home_goals"), F.col("away_goals")).alias("exact_score"),
    )
    rows = rows.withColumn("away", P.away_win(F.col("home"), F.col("draw"))).withColumn("under_25", 1.0 - F.col("over_25"))
    return _rounded(rows, *(c for c in rows.columns if c != "fixture_id"))


@query(f"""WITH {RATES}, {GRID} SELECT fixture_id, total, round(sum(p), 6) AS p FROM (SELECT fixture_id, CAST(h + a AS INTEGER) AS total, p FROM grid) WHERE total <= 6 GROUP BY ALL""")
def exact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: the probability of each number of goals."""
    totals = F.array(*(F.struct(F.lit(n).alias("total"), P.exact_total(*LINES, n).alias("p")) for n in range(7)))
    return _lines(spark, sf_dir).select("fixture_id", F.explode(totals).alias("t")).select("fixture_id", "t.total", F.round("t.p", 6).alias("p"))


@query(f"""WITH {RATES}, {GRID}, dc AS (SELECT g.fixture_id, h, a, greatest(0.0, p * CASE WHEN h = 0 AND a = 0 THEN 1 + 0.1 * home_attack * away_attack WHEN h = 0 AND a = 1 THEN 1 - 0.1 * home_attack WHEN h = 1 AND a = 0 THEN 1 - 0.1 * away_attack WHEN h = 1 AND a = 1 THEN 1.1 ELSE 1.0 END) AS p FROM grid g JOIN rates r ON r.fixture_id = g.fixture_id),
n AS (SELECT fixture_id, h, a, p / sum(p) OVER (PARTITION BY fixture_id) AS p FROM dc)
SELECT fixture_id, round(sum(CASE WHEN h > a THEN p ELSE 0 END), 6) AS home, round(sum(CASE WHEN h = a THEN p ELSE 0 END), 6) AS draw, round(sum(CASE WHEN h = 0 AND a = 0 THEN p ELSE 0 END), 6) AS goalless FROM n GROUP BY fixture_id""")
def dixon_coles_1x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: the low-score correction."""
    home, level, goalless = P.dixon_coles(*LINES, F.col("home_attack"), F.col("away_attack"))
    return _rounded(_lines(spark, sf_dir).select("fixture_id", home.alias("home"), level.alias("draw"), goalless.alias("goalless")), "home", "draw", "goalless")


@query(f"""WITH {RATES}, {GRID}, t AS (SELECT fixture_id, h, a, pow(p, 1.0 / 1.4) / sum(pow(p, 1.0 / 1.4)) OVER (PARTITION BY fixture_id) AS p FROM grid)
SELECT fixture_id, round(sum(CASE WHEN h > a THEN p ELSE 0 END), 6) AS home, round(sum(CASE WHEN h = a THEN p ELSE 0 END), 6) AS draw FROM t GROUP BY fixture_id""")
def temperature_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the joint grid at another temperature."""
    rows = _lines(spark, sf_dir).select("fixture_id", P.tempered(F.col("home_line"), 1.4).alias("h"), P.tempered(F.col("away_line"), 1.4).alias("a"))
    rows = rows.select("fixture_id", P.normalised(F.col("h")).alias("home_line"), P.normalised(F.col("a")).alias("away_line"))
    return _rounded(rows.select("fixture_id", P.home_win(*LINES).alias("home"), P.draw(*LINES).alias("draw")), "home", "draw")


@query(f"""WITH {MATCHES}, c AS (SELECT least(home_goals, 10) AS h, least(away_goals, 10) AS a, count(*) AS n FROM matches WHERE status = 'completed' GROUP BY ALL), g AS (SELECT CAST(x.h AS BIGINT) AS h, CAST(y.a AS BIGINT) AS a FROM range(0, 11) AS x(h), range(0, 11) AS y(a))
SELECT g.h AS home_goals, g.a AS away_goals, round((coalesce(c.n, 0) + 0.5) / sum(coalesce(c.n, 0) + 0.5) OVER (), 9) AS p FROM g LEFT JOIN c ON c.h = g.h AND c.a = g.a""")
def frequency_grid_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each score was seen, smoothed."""
    m = matches(spark, sf_dir).where("status = 'completed'")
    seen = m.groupBy(F.least("home_goals", F.lit(10)).alias("home_goals"), F.least("away_goals", F.lit(10)).alias("away_goals")).agg(F.count("*").alias("n"))
    cells = spark.range(121).select(F.floor(F.col("id") / 11).alias("home_goals"), F.pmod("id", F.lit(11)).alias("away_goals"))
    full = cells.join(seen, ["home_goals", "away_goals"], "left").withColumn("w", F.coalesce("n", F.lit(0)) + 0.5)
    total = full.agg(F.sum("w").alias("t"))
    return full.crossJoin(F.broadcast(total)).select("home_goals", "away_goals", F.round(F.col("w") / F.col("t"), 9).alias("p"))  # a single row


def _rated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = matches(spark, sf_dir).where("status = 'completed'")
    return m, ratings.elo(m)


_ELO = f"""WITH RECURSIVE {MATCHES}, o AS (SELECT fixture_id, competition, home_team, away_team, home_goals, away_goals, row_number() OVER (PARTITION BY competition ORDER BY kickoff_at, fixture_id) AS n FROM matches WHERE status = 'completed'),
f AS (SELECT competition, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS fixture_id, list_transform(range(20), lambda x: CAST(1500.0 AS DOUBLE)) AS r, CAST(NULL AS DOUBLE) AS hb, CAST(NULL AS DOUBLE) AS ab, CAST(0 AS DOUBLE) AS d FROM (SELECT DISTINCT competition FROM o)
  UNION ALL
  SELECT s.competition, s.n, s.fixture_id, list_transform(range(20), lambda t: CASE WHEN t = s.home_team THEN s.hb + s.d WHEN t = s.away_team THEN s.ab - s.d ELSE s.r[t + 1] END), s.hb, s.ab, s.d
  FROM (SELECT o.*, f.r, f.r[o.home_team + 1] AS hb, f.r[o.away_team + 1] AS ab, 20.0 * (CASE WHEN home_goals > away_goals THEN 1.0 WHEN home_goals = away_goals THEN 0.5 ELSE 0.0 END - 1.0 / (1.0 + pow(10.0, -(f.r[o.home_team + 1] + 60.0 - f.r[o.away_team + 1]) / 400.0))) AS d FROM f JOIN o ON o.competition = f.competition AND o.n = f.n + 1) s)"""


@query(f"""{_ELO} SELECT fixture_id, round(hb, 6) AS home_before, round(ab, 6) AS away_before, round(hb + d, 6) AS home_after, round(ab - d, 6) AS away_after FROM f WHERE n > 0""")
def elo_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings folded over matches in order, per competition."""
    return _rounded(_rated(spark, sf_dir)[1], "home_before", "away_before", "home_after", "away_after")


@query(f"""{_ELO} SELECT f.fixture_id, kickoff_at, home_team AS team, round(hb, 6) AS rating_before, round(hb + d, 6) AS rating_after FROM f JOIN matches m ON m.fixture_id = f.fixture_id WHERE n > 0
UNION ALL SELECT f.fixture_id, kickoff_at, away_team, round(ab, 6), round(ab - d, 6) FROM f JOIN matches m ON m.fixture_id = f.fixture_id WHERE n > 0""")
def power_rating_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per match and team."""
    m, rated = _rated(spark, sf_dir)
    return _rounded(ratings.history(rated, m), "rating_before", "rating_after")


@query(f"""{_ELO}, e AS (SELECT fixture_id, tanh((hb + 60.0 - ab) / 400.0) AS edge FROM f WHERE n > 0) SELECT fixture_id, round(greatest(0.05, 1.3 * (1.0 + 0.35 * edge)), 6) AS home_rate, round(greatest(0.05, 1.1 * (1.0 - 0.25 * edge)), 6) AS away_rate FROM e""")
def elo_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goal rates by the ratings before each match."""
    home, away = P.elo_rates(F.col("home_before"), F.col("away_before"), F.lit(1.3), F.lit(1.1))
    return _rounded(_rated(spark, sf_dir)[1].select("fixture_id", home.alias("home_rate"), away.alias("away_rate")), "home_rate", "away_rate")


_WALK = f"""{MATCHES}, x AS (SELECT fixture_id, competition, season, home_goals, away_goals, epoch_us(kickoff_at) AS cutoff FROM matches WHERE status = 'completed'),
k AS (SELECT *, count(*) OVER w AS n_before, greatest(0.05, coalesce(nullif(sum(home_goals) OVER w / count(*) OVER w, 0.0), 1.3)) AS hm, greatest(0.05, coalesce(nullif(sum(away_goals) OVER w / count(*) OVER w, 0.0), 1.1)) AS am FROM x WINDOW w AS (PARTITION BY competition ORDER BY cutoff RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(f"""WITH {_WALK} SELECT fixture_id, coalesce(n_before, 0) AS n_before, CASE WHEN coalesce(n_before, 0) >= 100 THEN round(hm, 6) END AS home_mean, CASE WHEN coalesce(n_before, 0) >= 100 THEN round(am, 6) END AS away_mean FROM k""")
def walk_forward_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over all earlier cut-offs, as sufficient statistics instead of refits."""
    m = matches(spark, sf_dir).where("status = 'completed'").withColumn("cutoff", F.unix_micros(F.col("kickoff_at").cast("timestamp")))
    out = E.training_means(m.select("fixture_id", "competition", "cutoff", "home_goals", "away_goals"), ["competition"], 100)
    return _rounded(out.select("fixture_id", "n_before", "home_mean", "away_mean"), "home_mean", "away_mean")


@query(f"""WITH {_WALK}, y AS (SELECT *, CASE WHEN home_goals > away_goals THEN 0 WHEN home_goals = away_goals THEN 1 ELSE 2 END AS actual FROM k),
z AS (SELECT fixture_id, actual, coalesce(count(*) OVER w, 0) AS n_before, coalesce(count(*) FILTER (WHERE actual = 0) OVER w, 0) AS h, coalesce(count(*) FILTER (WHERE actual = 1) OVER w, 0) AS d FROM y WINDOW w AS (PARTITION BY competition ORDER BY cutoff RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT fixture_id, n_before, round((h + 0.5) / (n_before + 1.5), 6) AS p_home, round((d + 0.5) / (n_before + 1.5), 6) AS p_draw FROM z WHERE n_before >= 100""")
def walk_forward_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome frequencies over all earlier cut-offs."""
    from chronopitch.operators.ordered import with_running

    m = matches(spark, sf_dir).where("status = 'completed'").withColumn("cutoff", F.unix_micros(F.col("kickoff_at").cast("timestamp")))
    home, level = (F.col("home_goals") > F.col("away_goals")).cast("long"), (F.col("home_goals") == F.col("away_goals")).cast("long")
    out = with_running(m.select("fixture_id", "competition", "cutoff", "home_goals", "away_goals"), ["competition"], "cutoff", {"n_before": F.lit(1).cast("long"), "h": home, "d": level}).where("n_before >= 100")
    return out.select("fixture_id", "n_before", F.round((F.col("h") + 0.5) / (F.col("n_before") + 1.5), 6).alias("p_home"), F.round((F.col("d") + 0.5) / (F.col("n_before") + 1.5), 6).alias("p_draw"))


@query(f"""WITH {FORECASTS} SELECT count(*) AS population, round(avg(log_loss), 6) AS log_loss, round(avg(brier_score), 6) AS brier_score, round(avg(rps), 6) AS rps, round(avg(sharpness), 6) AS sharpness FROM sc""")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled log loss, Brier, ranked probability score and sharpness."""
    return _rounded(E.summary(E.scored(_forecasts(spark, sf_dir))), *E.METRICS)


@query(f"""WITH {FORECASTS} SELECT season, count(*) AS population, round(avg(log_loss), 6) AS log_loss, round(avg(brier_score), 6) AS brier_score, round(avg(rps), 6) AS rps, round(avg(sharpness), 6) AS sharpness FROM sc GROUP BY season""")
def eval_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the same per season."""
    return _rounded(E.summary(E.scored(_forecasts(spark, sf_dir)), "season"), *E.METRICS)


_Z = "1.959963984540054"


@query(f"""WITH {FORECASTS}, l AS (SELECT season, unnest(['HOME', 'DRAW', 'AWAY']) AS label, unnest([p_home, p_draw, p_away]) AS p, unnest([actual = 0, actual = 1, actual = 2]) AS hit FROM sc),
b AS (SELECT label, CAST(least(9, floor(p * 10)) AS INTEGER) AS bin, count(*) AS n, avg(p) AS mean_p, CAST(sum(CAST(hit AS INTEGER)) AS BIGINT) AS hits FROM l GROUP BY ALL), q AS (SELECT *, hits / n AS f, 1.0 + {_Z} * {_Z} / n AS dn FROM b)
SELECT label, bin, n, round(mean_p, 6) AS mean_p, round(f, 6) AS observed, round(greatest(0.0, (f + {_Z} * {_Z} / (2.0 * n)) / dn - {_Z} * sqrt(f * (1.0 - f) / n + {_Z} * {_Z} / (4.0 * n * n)) / dn), 6) AS lower_95,
  round(least(1.0, (f + {_Z} * {_Z} / (2.0 * n)) / dn + {_Z} * sqrt(f * (1.0 - f) / n + {_Z} * {_Z} / (4.0 * n * n)) / dn), 6) AS upper_95 FROM q""")
def reliability_bins_wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability per outcome label, with Wilson intervals."""
    return _rounded(E.reliability(_labelled(spark, sf_dir), "p", "hit", ["label"]), "mean_p", "observed", "lower_95", "upper_95")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    labels = F.array(*(F.struct(F.lit(n).alias("label"), c(p).alias("p"), (c("actual") == i).alias("hit")) for i, (n, p) in enumerate((("HOME", "p_home"), ("DRAW", "p_draw"), ("AWAY", "p_away")))))
    return _forecasts(spark, sf_dir).select("season", F.explode(labels).alias("l")).select("season", "l.*")


@query(f"""WITH {FORECASTS}, b AS (SELECT season, least(9, floor(sharpness * 10)) AS bin, count(*) AS n, avg(sharpness) AS c, avg(CAST(hit AS INTEGER)) AS f FROM sc GROUP BY ALL) SELECT season, round(sum(n * abs(c - f)) / sum(n), 6) AS ece FROM b GROUP BY season""")
def ece_toplabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: calibration error of the label called."""
    return _rounded(E.calibration_error(E.scored(_forecasts(spark, sf_dir)), "sharpness", "hit", ["season"]), "ece")


@query(f"""WITH {FORECASTS}, l AS (SELECT season, unnest([p_home, p_draw, p_away]) AS p, unnest([actual = 0, actual = 1, actual = 2]) AS hit FROM sc), b AS (SELECT season, least(9, floor(p * 10)) AS bin, count(*) AS n, avg(p) AS c, avg(CAST(hit AS INTEGER)) AS f FROM l GROUP BY ALL)
SELECT season, round(sum(n * abs(c - f)) / sum(n), 6) AS ece FROM b GROUP BY season""")
def ece_classwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration error pooled over all three labels."""
    return _rounded(E.calibration_error(_labelled(spark, sf_dir), "p", "hit", ["season"]), "ece")


@query(f"""WITH {FORECASTS} SELECT season, count(*) AS n, round(avg(-p_home * ln(greatest(p_home, 1e-15)) - p_draw * ln(greatest(p_draw, 1e-15)) - p_away * ln(greatest(p_away, 1e-15))), 6) AS mean_entropy, round(avg(log_loss), 6) AS log_loss,
  CASE WHEN count(*) < 30 THEN 'insufficient_sample' WHEN count(*) < 100 THEN 'provisional' ELSE 'measured' END AS status FROM sc GROUP BY season""")
def monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy, loss and sample status per season."""
    rows = E.scored(_forecasts(spark, sf_dir)).withColumn("h", P.entropy(F.col("p_home"), F.col("p_draw"), F.col("p_away")))
    out = rows.groupBy("season").agg(F.count("*").alias("n"), F.avg("h").alias("mean_entropy"), F.avg("log_loss").alias("log_loss"))
    return _rounded(out.withColumn("status", E.sample_status(F.col("n"))), "mean_entropy", "log_loss")


@query(f"""WITH {RATES}, {GRID}, tt AS (SELECT 0.5 + 0.05 * i AS t FROM range(0, 51) AS x(i)),
pw AS (SELECT min(r.season) AS season, g.fixture_id, t, min(r.actual) AS actual, sum(CASE WHEN h > a THEN pow(p, 1.0 / t) ELSE 0 END) / sum(pow(p, 1.0 / t)) AS ph, sum(CASE WHEN h = a THEN pow(p, 1.0 / t) ELSE 0 END) / sum(pow(p, 1.0 / t)) AS pd FROM grid g JOIN rates r ON r.fixture_id = g.fixture_id, tt GROUP BY g.fixture_id, t),
ls AS (SELECT season, t, avg(-ln(least(1.0, greatest(1e-15, CASE actual WHEN 0 THEN ph WHEN 1 THEN pd ELSE greatest(0.0, 1.0 - ph - pd) END)))) AS loss FROM pw GROUP BY season, t)
SELECT season, round(arg_min(CAST(t AS DOUBLE), struct_pack(a := round(loss, 12), b := t)), 6) AS temperature, round(min(loss), 6) AS loss FROM ls GROUP BY season""")
def temperature_grid_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature of least loss over all forecasts, per season; `calibration_promotion` splits by time."""
    losses = E.temperature_losses(_lines(spark, sf_dir).select("season", "home_line", "away_line", "actual"), ["season"])
    return _rounded(E.best_temperature(losses, ["season"]), "temperature", "loss")


def _season_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss per model and season: Poisson and Dixon-Coles of fixed priors, and as 'frequency' one constant Poisson pair, which counts nothing."""
    rows = _lines(spark, sf_dir).withColumns({"ph": P.home_win(*LINES), "pd": P.draw(*LINES)})
    dc = P.dixon_coles(*LINES, F.col("home_attack"), F.col("away_attack"))
    rows = rows.withColumns({"dh": dc[0], "dd": dc[1], "_fh": P.poisson_line(F.lit(2.0)), "_fa": P.poisson_line(F.lit(1.5))})
    flat = P.total(F.col("_fh")) * P.total(F.col("_fa"))
    rows = rows.withColumns({"fh": P.home_win(F.col("_fh"), F.col("_fa")) / flat, "fd": P.draw(F.col("_fh"), F.col("_fa")) / flat})
    models = F.array(*(F.struct(F.lit(m).alias("model"), F.col(h).alias("p_home"), F.col(d).alias("p_draw")) for m, h, d in (("frequency", "fh", "fd"), ("poisson", "ph", "pd"), ("dixon_coles", "dh", "dd"))))
    long = rows.select("season", "actual", F.explode(models).alias("m")).select("season", "actual", "m.*")
    long = E.scored(long.withColumn("p_away", P.away_win(F.col("p_home"), F.col("p_draw"))))
    return long.groupBy("model", "season").agg(F.count("*").alias("population"), F.avg("log_loss").alias("log_loss"))


@query(f"""WITH {RATES}, {GRID},
dc AS (SELECT g.fixture_id, h, a, greatest(0.0, p * CASE WHEN h = 0 AND a = 0 THEN 1 + 0.1 * home_attack * away_attack WHEN h = 0 AND a = 1 THEN 1 - 0.1 * home_attack WHEN h = 1 AND a = 0 THEN 1 - 0.1 * away_attack WHEN h = 1 AND a = 1 THEN 1.1 ELSE 1.0 END) AS p FROM grid g JOIN rates r ON r.fixture_id = g.fixture_id),
fl AS (SELECT h, a, pow(2.0, h) / CAST(factorial(CAST(h AS INTEGER)) AS DOUBLE) * pow(1.5, a) / CAST(factorial(CAST(a AS INTEGER)) AS DOUBLE) AS p FROM range(0, 11) AS x(h), range(0, 11) AS y(a)),
pr AS (SELECT 'poisson' AS model, fixture_id, sum(CASE WHEN h > a THEN p ELSE 0 END) / sum(p) AS ph, sum(CASE WHEN h = a THEN p ELSE 0 END) / sum(p) AS pd FROM grid GROUP BY fixture_id
  UNION ALL SELECT 'dixon_coles', fixture_id, sum(CASE WHEN h > a THEN p ELSE 0 END) / sum(p), sum(CASE WHEN h = a THEN p ELSE 0 END) / sum(p) FROM dc GROUP BY fixture_id
  UNION ALL SELECT 'frequency', fixture_id, (SELECT sum(CASE WHEN h > a THEN p ELSE 0 END) / sum(p) FROM fl), (SELECT sum(CASE WHEN h = a THEN p ELSE 0 END) / sum(p) FROM fl) FROM rates),
l AS (SELECT model, season, -ln(least(1.0, greatest(1e-15, CASE actual WHEN 0 THEN ph WHEN 1 THEN pd ELSE greatest(0.0, 1.0 - ph - pd) END))) AS loss FROM pr JOIN rates r ON r.fixture_id = pr.fixture_id),
s AS (SELECT model, season, count(*) AS n, avg(loss) AS loss FROM l GROUP BY model, season), m AS (SELECT model, sum(n * loss) / sum(n) AS pooled, stddev_pop(loss) AS spread FROM s GROUP BY model),
t AS (SELECT *, pooled + 0.10 * spread AS score FROM m), b AS (SELECT *, (SELECT score FROM t WHERE model = 'frequency') AS base, (SELECT arg_min(model, struct_pack(a := score, b := model)) FROM t) AS best FROM t)
SELECT model, round(pooled, 6) AS pooled, round(spread, 6) AS spread, round(score, 6) AS score, model = best AND (model = 'frequency' OR score <= base - 0.005) AS selected FROM b""")
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed models ranked by loss and its spread over seasons against a constant pair; `walk_forward_selection` refits them."""
    return _rounded(E.ranking(_season_losses(spark, sf_dir), "frequency"), "pooled", "spread", "score")


def _walk_forward(spark: SparkSession, sf_dir: str, least: int = 100) -> DataFrame:
    """(fixture_id, season, actual, model, p_home, p_draw, p_away): four models, each fit on the matches of its
    competition with a strictly earlier cut-off, for matches that have `least` of them. Refits are running sums."""
    from chronopitch.operators.ordered import with_running

    c, key = F.col, ["competition"]
    m = matches(spark, sf_dir).where("status = 'completed' AND home_goals IS NOT NULL AND away_goals IS NOT NULL").withColumn("cutoff", F.unix_micros(c("kickoff_at").cast("timestamp")))
    rows = E.training_means(m.select("fixture_id", "competition", "season", "cutoff", "home_goals", "away_goals"), key, least)
    h, a = (F.least(c(x), F.lit(P.TOP)) for x in ("home_goals", "away_goals"))  # the last cell of the grid holds all beyond
    rows = with_running(rows, key, "cutoff", {"wins": (h > a).cast("long"), "level": (h == a).cast("long")}).where(c("n_before") >= least)
    form = pit.snapshot(matches(spark, sf_dir)).drop("kickoff_at")
    rows = rows.join(form, "fixture_id").join(ratings.elo(m, strictly=True).select("fixture_id", "home_before", "away_before"), "fixture_id")
    hm, am = c("home_mean"), c("away_mean")
    home, away = P.poisson_rates(c("home_goals_for_avg"), c("away_goals_against_avg"), c("away_goals_for_avg"), c("home_goals_against_avg"), hm, am)
    eh, ea = P.elo_rates(c("home_before"), c("away_before"), hm, am)
    attack = lambda name, rest: F.coalesce(F.nullif(P.usable(c(name), rest), F.lit(0.0)), rest)
    actual = F.when(c("home_goals") > c("away_goals"), 0).when(c("home_goals") == c("away_goals"), 1).otherwise(2)
    rows = rows.select("fixture_id", "season", actual.alias("actual"), "n_before", "wins", "level", home.alias("hr"), away.alias("ar"), eh.alias("er"), ea.alias("fr"), attack("home_goals_for_avg", hm).alias("ha"), attack("away_goals_for_avg", am).alias("aa"))
    lines = {"home_line": "hr", "away_line": "ar", "elo_home": "er", "elo_away": "fr"}
    rows = rows.withColumns({f"_{n}": P.poisson_line(c(r)) for n, r in lines.items()}).withColumns({n: P.normalised(c(f"_{n}")) for n in lines})
    dh, dd, _ = P.dixon_coles(*LINES, c("ha"), c("aa"))
    cells = F.lit(0.5 * P.SIZE * P.SIZE) + c("n_before")  # every score is seen half a time more
    beyond = 0.5 * P.SIZE * (P.SIZE - 1) / 2
    each = {
        "frequency": ((c("wins") + beyond) / cells, (c("level") + 0.5 * P.SIZE) / cells), "poisson": (P.home_win(*LINES), P.draw(*LINES)),
        "elo": (P.home_win(c("elo_home"), c("elo_away")), P.draw(c("elo_home"), c("elo_away"))), "dixon_coles": (dh, dd),
    }
    models = F.array(*(F.struct(F.lit(n).alias("model"), p.alias("p_home"), d.alias("p_draw")) for n, (p, d) in each.items()))
    long = rows.select("fixture_id", "season", "actual", F.explode(models).alias("m")).select("fixture_id", "season", "actual", "m.*")
    return long.withColumn("p_away", P.away_win(c("p_home"), c("p_draw")))


@query()
def walk_forward_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency, Poisson, Elo and Dixon-Coles, refit at each cut-off on what came before it, ranked by loss
    and its spread over seasons. Without a winner by the margin the frequency baseline is selected."""
    losses = E.scored(_walk_forward(spark, sf_dir)).groupBy("model", "season").agg(F.count("*").alias("population"), F.avg("log_loss").alias("log_loss"))
    out = E.ranking(cut(losses), "frequency")
    any_ = out.agg(F.max("selected").alias("any"))
    out = out.crossJoin(F.broadcast(any_)).withColumn("selected", F.col("selected") | (~F.col("any") & (F.col("model") == "frequency"))).drop("any")  # a single row
    return _rounded(out, "pooled", "spread", "score")


@query()
def calibration_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temperature fit on the first half of each competition, judged on the second half, season by season."""
    rows = cut(_lines(spark, sf_dir).select("competition", "season", "kickoff_at", "fixture_id", "home_line", "away_line", "actual"))
    half = rows.groupBy("competition").agg(F.percentile_approx(F.unix_micros(F.col("kickoff_at").cast("timestamp")), 0.5, 10_000).alias("middle"))
    rows = rows.join(F.broadcast(half), "competition").withColumn("fit", F.unix_micros(F.col("kickoff_at").cast("timestamp")) <= F.col("middle"))
    best = E.best_temperature(E.temperature_losses(rows.where("fit"), ["competition"]), ["competition"]).select("competition", "temperature")
    held = rows.where("NOT fit").join(F.broadcast(best), "competition")
    held = held.withColumns({"_h": P.tempered(F.col("home_line"), F.col("temperature")), "_a": P.tempered(F.col("away_line"), F.col("temperature"))})
    whole = P.total(F.col("_h")) * P.total(F.col("_a"))
    held = held.withColumns({"rh": P.home_win(*LINES), "rd": P.draw(*LINES), "ch": P.home_win(F.col("_h"), F.col("_a")) / whole, "cd": P.draw(F.col("_h"), F.col("_a")) / whole})
    loss = lambda h, d: P.log_loss(F.when(F.col("actual") == 0, F.col(h)).when(F.col("actual") == 1, F.col(d)).otherwise(P.away_win(F.col(h), F.col(d))))
    per = held.groupBy("competition", "season").agg(F.avg(loss("rh", "rd")).alias("raw"), F.avg(loss("ch", "cd")).alias("calibrated"), F.count("*").alias("n"))
    out = per.groupBy("competition").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("raw")) / F.sum("n")).alias("raw"), (F.sum(F.col("n") * F.col("calibrated")) / F.sum("n")).alias("calibrated"), F.count_if(F.col("calibrated") < F.col("raw")).alias("better_seasons"), F.count("*").alias("seasons"))
    out = out.join(best, "competition").withColumn("promoted", (F.col("calibrated") < F.col("raw")) & (F.col("better_seasons") * 2 > F.col("seasons")))
    return _rounded(out, "raw", "calibrated", "temperature")
