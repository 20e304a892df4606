"""Elo ratings: a fold over matches in order, one competition after another."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K_FACTOR, ADVANTAGE, BASE = 20.0, 60.0, 1500.0


def elo(matches: DataFrame, k: float = K_FACTOR, advantage: float = ADVANTAGE, base: float = BASE, strictly: bool = False) -> DataFrame:
    """(fixture_id, home_before, away_before, home_after, away_after), each match once, in order of kick-off and id.

    matches: competition, fixture_id, kickoff_at, home_team, away_team, home_goals, away_goals; matches without a
    score change nothing and have no row. A fold cannot be split within a competition: its rows are streamed in order
    through one task that holds the ratings of its teams only, never its rows; competitions run side by side.
    `strictly`: the ratings before are those before the kick-off, without other matches of the same time.
    """
    rows = matches.where("home_goals IS NOT NULL AND away_goals IS NOT NULL")
    kind = {n: t for n, t in rows.dtypes}
    line = rows.select(F.col("competition").cast("string").alias("c"), "fixture_id", F.col("home_team").cast("string").alias("h"), F.col("away_team").cast("string").alias("a"), "home_goals", "away_goals", "kickoff_at")
    line = line.repartition("c").sortWithinPartitions("c", "kickoff_at", "fixture_id")
    line = line.withColumn("kickoff_at", F.unix_micros(F.col("kickoff_at").cast("timestamp")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratings: dict[str, float] = {}
        earlier: dict[str, float] = {}  # what matches of the present kick-off have changed, as it was before them
        at, time = object(), None
        for batch in batches:
            out = [[], [], [], []]
            for c, h, a, hg, ag, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6))):
                if c != at:
                    ratings, earlier, at, time = {}, {}, c, t
                if t != time:
                    earlier, time = {}, t
                x, y = ratings.get(h, base), ratings.get(a, base)
                expected = 1.0 / (1.0 + 10.0 ** (-(x + advantage - y) / 400.0))
                delta = k * ((1.0 if hg > ag else 0.5 if hg == ag else 0.0) - expected)
                ratings[h], ratings[a] = x + delta, y - delta
                if strictly:
                    before = earlier.setdefault(h, x), earlier.setdefault(a, y)
                else:
                    before = x, y
                for values, v in zip(out, (*before, x + delta, y - delta)):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(v, pa.float64()) for v in out)], ["fixture_id", "home_before", "away_before", "home_after", "away_after"])

    return line.mapInArrow(run, f"fixture_id {kind['fixture_id']}, home_before double, away_before double, home_after double, away_after double")


def history(rated: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per match and team: rating before and after."""
    both = matches.select("fixture_id", "kickoff_at", "home_team", "away_team").join(rated, "fixture_id")
    side = lambda s: F.struct(F.col(f"{s}_team").alias("team"), F.col(f"{s}_before").alias("rating_before"), F.col(f"{s}_after").alias("rating_after"))
    return both.select("fixture_id", "kickoff_at", F.explode(F.array(side("home"), side("away"))).alias("s")).select("fixture_id", "kickoff_at", "s.*")
