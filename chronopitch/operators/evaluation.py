"""Scoring of forecasts, reliability, calibration by a grid of temperatures, and the choice of a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopitch.functions import probability as P
from chronopitch.operators.ordered import with_running

METRICS = ("log_loss", "brier_score", "rps", "sharpness")


def scored(forecasts: DataFrame) -> DataFrame:
    """Row metrics of forecasts: p_home, p_draw, p_away and actual (0 home, 1 draw, 2 away). Ties of the top go to the first."""
    p = [F.col(c) for c in ("p_home", "p_draw", "p_away")]
    top = F.greatest(*p)
    near = [F.round(x, 9) for x in p]  # sides of equal rates differ in the last bit only: that is a tie
    best = F.when(near[0] == F.greatest(*near), 0).when(near[1] == F.greatest(*near), 1).otherwise(2)
    own = F.get(F.array(*p), F.col("actual").cast("int"))
    return forecasts.withColumns(
        {
            "log_loss": P.log_loss(own), "brier_score": P.brier(*p, F.col("actual")), "rps": P.ranked_probability_score(p[0], p[1], F.col("actual")),
            "sharpness": top, "hit": (best == F.col("actual")).cast("int"),
        }
    )


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """Population and mean metrics per group."""
    return rows.groupBy(*by).agg(F.count("*").alias("population"), *(F.avg(m).alias(m) for m in METRICS))


def bin_of(p: Column, bins: int = 10) -> Column:
    return F.least(F.lit(bins - 1), F.floor(p * bins)).cast("int")


def reliability(rows: DataFrame, p: str, hit: str, by: list[str], bins: int = 10) -> DataFrame:
    """Per group and bin: how many, mean probability, share of hits and its 95 % interval."""
    per = rows.groupBy(*by, bin_of(F.col(p), bins).alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.sum(F.col(hit).cast("long")).alias("hits"))
    low, high = P.wilson(F.col("hits"), F.col("n"))
    return per.select(*by, "bin", "n", "mean_p", (F.col("hits") / F.col("n")).alias("observed"), low.alias("lower_95"), high.alias("upper_95"))


def calibration_error(rows: DataFrame, p: str, hit: str, by: list[str], bins: int = 10) -> DataFrame:
    """The mean distance of probability and share of hits over bins, by their size."""
    per = reliability(rows, p, hit, by, bins)
    return per.groupBy(*by).agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("observed"))) / F.sum("n")).alias("ece"))


def sample_status(n: Column, least: int = 30, provisional: int = 100) -> Column:
    return F.when(n < least, "insufficient_sample").when(n < provisional, "provisional").otherwise("measured")


def temperatures() -> list[float]:
    return [0.5 + 0.05 * i for i in range(51)]


def temperature_losses(forecasts: DataFrame, by: list[str]) -> DataFrame:
    """Mean log loss of each temperature of the grid, in one pass. forecasts: home_line, away_line, actual."""
    rows = forecasts.withColumn("_t", F.explode(F.array(*(F.lit(t) for t in temperatures()))))
    line = lambda c: P.tempered(F.col(c), F.col("_t"))
    rows = rows.select(*by, "actual", "_t", line("home_line").alias("_h"), line("away_line").alias("_a"))
    whole = P.total(F.col("_h")) * P.total(F.col("_a"))
    rows = rows.select(*by, "actual", "_t", (P.home_win(F.col("_h"), F.col("_a")) / whole).alias("_hw"), (P.draw(F.col("_h"), F.col("_a")) / whole).alias("_dw"))
    own = F.when(F.col("actual") == 0, F.col("_hw")).when(F.col("actual") == 1, F.col("_dw")).otherwise(P.away_win(F.col("_hw"), F.col("_dw")))
    return rows.groupBy(*by, F.col("_t").alias("temperature")).agg(F.avg(P.log_loss(own)).alias("loss"))


def best_temperature(losses: DataFrame, by: list[str]) -> DataFrame:
    """The temperature of least loss, the first of equal ones."""
    return losses.groupBy(*by).agg(F.min_by("temperature", F.struct(F.round("loss", 12), F.col("temperature"))).alias("temperature"), F.min("loss").alias("loss"))


def training_means(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """Each row with the goals a side averaged over all rows with an earlier cut-off: expanding, strictly before.

    rows: cutoff (long), home_goals, away_goals. Rows with fewer than `least` examples before them have no means.
    """
    out = with_running(rows, key, "cutoff", {"n_before": F.lit(1).cast("long"), "home_sum": F.col("home_goals").cast("long"), "away_sum": F.col("away_goals").cast("long")})
    mean = lambda c, rest: F.when(F.col("n_before") >= least, F.greatest(F.lit(0.05), F.coalesce(F.nullif(F.col(c) / F.nullif("n_before", F.lit(0)), F.lit(0.0)), F.lit(rest))))
    return out.withColumn("home_mean", mean("home_sum", 1.3)).withColumn("away_mean", mean("away_sum", 1.1))


def ranking(season_losses: DataFrame, baseline: str, spread: float = 0.10, margin: float = 0.005) -> DataFrame:
    """Models by pooled loss plus a share of its spread over seasons; a model is chosen only if it beats the baseline by the margin.

    season_losses: model, season, population, log_loss. The spread is that of the population of seasons.
    """
    per = season_losses.groupBy("model").agg((F.sum(F.col("population") * F.col("log_loss")) / F.sum("population")).alias("pooled"), F.stddev_pop("log_loss").alias("spread"))
    per = per.withColumn("score", F.col("pooled") + spread * F.col("spread"))
    base = per.where(F.col("model") == baseline).select(F.col("score").alias("base"))
    out = per.crossJoin(F.broadcast(base))  # a single row
    best = out.agg(F.min_by("model", F.struct("score", "model")).alias("best"))
    out = out.crossJoin(F.broadcast(best))  # a single row
    fine = (F.col("model") == F.col("best")) & ((F.col("model") == baseline) | (F.col("score") <= F.col("base") - margin))
    return out.select("model", "pooled", "spread", "score", fine.alias("selected"))
