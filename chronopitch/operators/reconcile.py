"""Identity, matching and reconciliation of records from several sources, by explicit ids and never by display names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNRESOLVED, AMBIGUOUS, CONFIRMED = "unresolved", "ambiguous", "confirmed"


def keep_best(rows: DataFrame, key: list[str], complete: Column, *order: Column) -> DataFrame:
    """One row a key: the last complete one, else the last; by partial aggregation."""
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    return rows.groupBy(*key).agg(F.max_by(whole, F.struct(complete.cast("int"), *order)).alias("_r")).select("_r.*")


def conflicts(rows: DataFrame, key: list[str], fields: list[str], *order: Column) -> DataFrame:
    """Per key with rows that differ: how many rows and which fields differ; a null differs from every value.

    A field differs where its least and greatest value do, or where it has both nulls and values: plain aggregates, no
    copy of the rows for each field. Fields must be of an orderable type.
    """
    apart = lambda f: (F.min(f) != F.max(f)) | ((F.count(f) > 0) & (F.count(f) < F.count("*")))
    differ = F.array_compact(F.array(*(F.when(F.coalesce(apart(f), F.lit(False)), F.lit(f)) for f in fields)))
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows"), differ.alias("differing")).where(F.size("differing") > 0)


def differing_fields(pairs: list[tuple[str, Column, Column]]) -> Column:
    """The names of the fields that two matched rows tell differently; null agrees with null only."""
    return F.array_compact(F.array(*(F.when(~a.eqNullSafe(b), F.lit(name)) for name, a, b in pairs)))


def match_fixtures(ours: DataFrame, theirs: DataFrame, hours: int = 36) -> DataFrame:
    """Each source fixture with its canonical fixture: same pair of teams, seasons compatible, kick-offs within `hours`.

    ours: source_fixture_id, home_team, away_team, season, kickoff_at; theirs: canonical_fixture_id and the same. Both
    sides meet by pair and blocks of the tolerance, so fixtures of a pair that are years apart are never paired.
    """
    width = hours * 3_600_000_000
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    a = ours.withColumn("_at", at("kickoff_at")).withColumn("_block", F.floor(F.col("_at") / width))
    b = theirs.select("canonical_fixture_id", "home_team", "away_team", F.col("season").alias("_season"), at("kickoff_at").alias("_other"))
    b = b.withColumn("_block", F.explode(F.transform(F.array(*(F.lit(i) for i in (-1, 0, 1))), lambda i: F.floor(F.col("_other") / width) + i)))
    delta = F.abs(F.col("_at") - F.col("_other"))
    pair = a.join(b, ["home_team", "away_team", "_block"]).where((delta <= width) & (F.col("season").isNull() | F.col("_season").isNull() | (F.col("season") == F.col("_season"))))
    near = pair.groupBy("source_fixture_id").agg(F.count("*").alias("candidates"), F.min_by("canonical_fixture_id", F.struct(delta, F.col("canonical_fixture_id"))).alias("nearest"), F.min(delta).alias("_delta"))
    out = ours.join(near, "source_fixture_id", "left").na.fill({"candidates": 0})
    status = F.when(F.col("candidates") == 0, UNRESOLVED).when(F.col("candidates") == 1, CONFIRMED).otherwise(AMBIGUOUS)
    return out.select("source_fixture_id", "candidates", status.alias("status"), F.when(F.col("candidates") > 0, F.col("nearest")).alias("nearest"), (F.col("_delta") / 60_000_000).alias("delta_minutes"))


def resolve(rows: DataFrame, explicit: DataFrame, by_source: DataFrame, by_id: DataFrame) -> DataFrame:
    """Each row's canonical id: by an explicit map, else by source and id, else by the id alone; null where none has it.

    rows: source, source_id; explicit and by_source: source, source_id, canonical_id; by_id: source_id, canonical_id.
    """
    key = ["source", "source_id"]
    one = lambda df, on, name: df.groupBy(*on).agg(F.min("canonical_id").alias(name), F.count_distinct("canonical_id").alias(f"_{name}")).where(F.col(f"_{name}") == 1).drop(f"_{name}")
    out = rows.join(one(explicit, key, "_e"), key, "left").join(one(by_source, key, "_s"), key, "left").join(one(by_id, ["source_id"], "_i"), "source_id", "left")
    path = F.when(F.col("_e").isNotNull(), "explicit").when(F.col("_s").isNotNull(), "source").when(F.col("_i").isNotNull(), "id").otherwise(UNRESOLVED)
    return out.select(*rows.columns, F.coalesce("_e", "_s", "_i").alias("canonical_id"), path.alias("resolved_by"))


def unique_names(names: DataFrame, key: Column) -> DataFrame:
    """Name keys that stand for exactly one id: the others establish nothing. names: id."""
    return names.select(key.alias("name_key"), "id").where("name_key != ''").groupBy("name_key").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id")).where("n = 1").select("name_key", "id")


def confirmed_by_several(identities: DataFrame, least: int = 2) -> DataFrame:
    """Canonical ids that at least `least` sources share. identities: entity_type, canonical_id, source."""
    return identities.groupBy("entity_type", "canonical_id").agg(F.count_distinct("source").alias("sources")).where(F.col("sources") >= least)


def latest_mapping(log: DataFrame) -> DataFrame:
    """The state of each mapping from its log: the latest decision; of an id, at most one may be confirmed.

    log: source_fixture_id, canonical_fixture_id, status, decided_at. Ids with several confirmed come out ambiguous.
    """
    last = log.groupBy("source_fixture_id", "canonical_fixture_id").agg(F.max_by("status", F.struct("decided_at", "status")).alias("status"))
    several = Window.partitionBy("source_fixture_id")
    last = last.withColumn("_n", F.count_if(F.col("status") == CONFIRMED).over(several))
    return last.select("source_fixture_id", "canonical_fixture_id", F.when((F.col("status") == CONFIRMED) & (F.col("_n") > 1), AMBIGUOUS).otherwise(F.col("status")).alias("status"))


def coverage(rows: DataFrame, *by: str) -> DataFrame:
    """Rows and distinct fixtures per source, capability and state."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_distinct("fixture_id").alias("fixtures"))
