"""Point-in-time features: what a match's sides had done before kick-off, as it was known by the cut-off."""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopitch.operators.ordered import with_last, with_running
from chronopitch.operators.skew import hot_bounds, piece
from chronopitch.session import width

#: How a match's facts became known, from the strongest basis to none.
ACTUAL, KNOWN, REVISION, DERIVED, UNKNOWN = "actual_source_timestamp", "knowledge_timestamp", "revision_timestamp", "event_derived_reconstruction", "unknown"
SAFETY, UNKNOWN_TIME_SAFETY = "INTERVAL 3 HOURS", "INTERVAL 30 HOURS"


def eligible_at(basis: Column, available: Column, known: Column, kickoff: Column, local_time: Column, derived: Column) -> Column:
    """When a match's result may be used: by its basis; never where the basis is unknown."""
    return (
        F.when(basis.isin(ACTUAL, REVISION), F.greatest(available, known))
        .when(basis == KNOWN, known)
        .when(basis == DERIVED, F.coalesce(derived, F.when(local_time.isNull(), kickoff + F.expr(UNKNOWN_TIME_SAFETY)).otherwise(kickoff + F.expr(SAFETY))))
    )


def team_rows(matches: DataFrame, *keep: str) -> DataFrame:
    """Two rows a match, one a side: team, opponent, is_home, gf, ga, points, and the columns kept."""
    side = lambda own, other, home: F.struct(F.col(f"{own}_team").alias("team"), F.col(f"{other}_team").alias("opponent"), F.lit(home).alias("is_home"), F.col(f"{own}_goals").alias("gf"), F.col(f"{other}_goals").alias("ga"))
    rows = matches.select("fixture_id", "kickoff_at", *keep, F.explode(F.array(side("home", "away", True), side("away", "home", False))).alias("s"))
    points = F.when(F.col("s.gf") > F.col("s.ga"), 3).when(F.col("s.gf") == F.col("s.ga"), 1).when(F.col("s.gf") < F.col("s.ga"), 0)
    return rows.select("fixture_id", "kickoff_at", *keep, "s.*", points.alias("points"))


def form(matches: DataFrame, n: int = 5, venue: bool = False) -> DataFrame:
    """Per match and side the averages over the side's n completed matches before it (at its venue only, if asked).

    For matches whose results are known in the order they are played; `form_as_known` drops that assumption.
    """
    rows = team_rows(matches).withColumn("_at", F.unix_micros(F.col("kickoff_at").cast("timestamp")))
    key = ["team", "is_home"] if venue else ["team"]
    before = lambda c: F.avg(c)
    values = {
        "matches_seen": F.count(F.lit(1)), "points_avg": before("points"), "goals_for_avg": before("gf"), "goals_against_avg": before("ga"),
        "rest_days": lambda w: (F.col("_at") - F.lag("_at").over(w)) / F.lit(86_400_000_000.0),
    }
    return with_last(rows, key, "_at", "fixture_id", n, values).drop("_at")


def snapshot(matches: DataFrame, n: int = 5) -> DataFrame:
    """One row a match with both sides' form."""
    names = ("matches_seen", "points_avg", "goals_for_avg", "goals_against_avg", "rest_days")
    rows = form(matches, n)
    pick = lambda side, home: [F.max(F.when(F.col("is_home") == home, F.col(c))).alias(f"{side}_{c}") for c in names]
    return rows.groupBy("fixture_id", "kickoff_at").agg(*pick("home", True), *pick("away", False))


def _running_form(n: int):
    """Streams (team, piece, time)-ordered rows: history enters when it may be used, a target reads the n latest of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, latest, count = None, [], 0
        for batch in batches:
            out = [[] for _ in range(8)]
            for team, piece, kind, weight, fixture, kickoff, points, gf, ga, row in zip(*(batch.column(i).to_pylist() for i in range(10))):
                if (team, piece) != at:
                    at, latest, count = (team, piece), [], 0
                if kind < 1:
                    count += weight
                    if kickoff is not None and (len(latest) < n or (kickoff, fixture) > latest[0][:2]):
                        insort(latest, (kickoff, fixture, points, gf, ga))
                        del latest[:-n]
                    continue
                mean = lambda i: sum(r[i] for r in latest) / len(latest) if latest else None  # noqa: B023, E731
                for values, v in zip(out, (row, len(latest), mean(2), mean(3), mean(4), latest[-1][0] if latest else None, count, team)):
                    values.append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["_row", "matches_seen", "points_avg", "goals_for_avg", "goals_against_avg", "_last", "_used", "_team"])

    return run


def form_as_known(targets: DataFrame, history: DataFrame, n: int = 5) -> DataFrame:
    """Per target side the averages over the last n matches that were played before kick-off and eligible by the cut-off.

    targets: fixture_id (long), team, kickoff_at, cutoff_at (not after kick-off); history: fixture_id, team, kickoff_at,
    eligible_at, gf, ga, points. Matches played before kick-off but not eligible are counted as blocked. History and
    targets are put in one order by team and time and read once, with n rows of state: no pairs of rows are made. A
    team with more than its share of rows is cut by time, each piece starting from the n latest of those before it.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    t = targets.select("fixture_id", F.col("team").cast("string").alias("t"), micros("kickoff_at").alias("kickoff"), micros("cutoff_at").alias("time"))
    h = history.where("eligible_at IS NOT NULL").select(F.col("fixture_id").alias("fixture_id"), F.col("team").cast("string").alias("t"), micros("kickoff_at").alias("kickoff"), F.greatest(micros("eligible_at"), micros("kickoff_at") + 1).alias("time"), *(F.col(c).cast("double").alias(c) for c in ("points", "gf", "ga")))
    none = F.lit(None).cast("double")
    rows = h.withColumns({"kind": F.lit(0), "weight": F.lit(1).cast("long")}).unionByName(t.withColumns({"points": none, "gf": none, "ga": none, "kind": F.lit(1), "weight": F.lit(0).cast("long")}))
    bounds = hot_bounds(rows.select("t", "time"), ["t"], "time", width(rows.sparkSession, 2))
    rows = rows.join(F.broadcast(bounds), "t", "left").withColumn("piece", piece(F.col("time"), F.col("bounds")))
    # What a piece of a hot team starts from: the number of rows in the pieces before it, and the n latest of each.
    own = rows.where((F.col("kind") == 0) & F.col("bounds").isNotNull())
    tops = own.withColumn("_r", F.row_number().over(Window.partitionBy("t", "piece").orderBy(F.desc("kickoff"), F.desc("fixture_id")))).where(F.col("_r") <= n).drop("_r").withColumn("weight", F.lit(0).cast("long"))
    sizes = own.groupBy("t", "piece", "bounds").agg(F.sum("weight").alias("weight")).withColumns({"fixture_id": F.lit(None).cast("long"), "kickoff": F.lit(None).cast("long"), "time": F.lit(0).cast("long"), "points": none, "gf": none, "ga": none, "kind": F.lit(0)})
    ahead = tops.unionByName(sizes).withColumn("piece", F.explode(F.when(F.col("piece") < F.size("bounds"), F.sequence(F.col("piece") + 1, F.size("bounds"))))).withColumns({"kind": F.lit(-1), "time": F.lit(-(2**62))})
    names = ["t", "piece", "kind", "weight", "fixture_id", "kickoff", "points", "gf", "ga", "row", "time"]
    line = rows.unionByName(ahead).withColumn("row", F.col("fixture_id")).select(*names)
    line = line.repartition("t", "piece").sortWithinPartitions("t", "piece", "time", "kind", "kickoff", "fixture_id").drop("time")
    schema = "_row long, matches_seen long, points_avg double, goals_for_avg double, goals_against_avg double, _last long, _used long, _team string"
    got = line.mapInArrow(_running_form(n), schema)
    # All matches played before, eligible or not, by a running count.
    all_h = history.select(F.col("team").cast("string").alias("t"), micros("kickoff_at").alias("kickoff"), F.lit(None).cast("long").alias("fixture_id"), F.lit(1).cast("long").alias("one"))
    played = with_running(all_h.unionByName(t.select("t", "kickoff", "fixture_id", F.lit(0).cast("long").alias("one"))), ["t"], "kickoff", {"played": F.col("one")}).where("fixture_id IS NOT NULL")
    out = targets.select("fixture_id", "team", "kickoff_at", "cutoff_at", F.col("team").cast("string").alias("_team"), F.col("fixture_id").alias("_row"))
    out = out.join(got, ["_team", "_row"]).join(played.select(F.col("t").alias("_team"), F.col("fixture_id").alias("_row"), "played"), ["_team", "_row"])
    rest = (micros("kickoff_at") - F.col("_last")) / F.lit(86_400_000_000.0)
    return out.withColumns({"blocked": F.col("played") - F.col("_used"), "rest_days": rest}).drop("_team", "_row", "_last", "_used", "played")


def missingness(value: Column, blocked: Column, provider_blocked: Column | None = None, counts: bool = False) -> Column:
    """Why a feature is as it is: pit_ineligible before observed before unknown before missing."""
    nothing = value.isNull() | (value == 0) if counts else value.isNull()
    return (
        F.when(blocked & nothing, "pit_ineligible").when(value.isNotNull(), "observed")
        .when(provider_blocked if provider_blocked is not None else F.lit(False), "unknown").otherwise("missing")
    )


def merged_basis(bases: Column) -> Column:
    """The basis of a feature made of several matches: their one basis, else the weakest."""
    return (
        F.when(F.size(bases) <= 0, UNKNOWN).when(F.size(F.array_distinct(bases)) == 1, F.get(bases, 0))
        .when(F.array_contains(bases, UNKNOWN), UNKNOWN).when(F.array_contains(bases, DERIVED), DERIVED).otherwise(REVISION)
    )


def violations(checks: dict[str, Column]) -> Column:
    """The codes of the checks that a row breaks (a check that is null is not broken)."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(code)) for code, bad in checks.items())))


def record_checks() -> dict[str, Column]:
    """What a match record must keep to."""
    c = F.col
    return {
        "observed_after_available": c("source_observed_at") > c("source_available_at"), "available_after_known": c("source_available_at") > c("knowledge_at"),
        "known_after_processed": c("knowledge_at") > c("processing_at"), "one_score_missing": c("home_goals").isNull() != c("away_goals").isNull(),
        "negative_goals": (c("home_goals") < 0) | (c("away_goals") < 0), "same_team": c("home_team") == c("away_team"),
        "known_before_kickoff": c("home_goals").isNotNull() & (c("knowledge_at") < c("kickoff_at")),
    }


def ledger_checks() -> dict[str, Column]:
    """What a ledger entry must keep to."""
    c = F.col
    return {
        "known_after_created": c("knowledge_at") > c("created_at"), "known_after_processed": c("knowledge_at") > c("processing_at"),
        "observed_after_available": c("source_observed_at") > c("available_at"), "success_without_evidence": (c("state") == "success") & c("evidence_id").isNull(),
        "missed_with_evidence": (c("state") == "missed_observation") & c("evidence_id").isNotNull(),
    }


def as_known_at(ledger: DataFrame, cutoff: Column, capability: str | None = None) -> DataFrame:
    """Successful entries known by the cut-off."""
    rows = ledger.where((F.col("knowledge_at") <= cutoff) & (F.col("state") == "success"))
    return rows if capability is None else rows.where(F.col("capability") == capability)
