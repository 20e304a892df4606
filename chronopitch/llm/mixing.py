"""Mixing sources to target weights, by capped water-filling and seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most sources of a mix.
SOURCES = 10_000
#: Slices of a source in seeded order: the fraction of a source is whole slices and a running sum within one.
SLICES = 1 << 16


def source_name(c: Column | str) -> Column:
    """A source's name in one written form: lower case, outer blanks off, underscores for dashes and blanks."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"[\s ]+", " "))), r"[- ]+", "_")


def water_fill(targets: dict[str, float], limits: dict[str, float], total: float) -> dict[str, float]:
    """Sizes near total * target, none above its limit: what a clamped source cannot take goes to the others in
    proportion to their targets, until no other is above its limit. Sums to the lesser of total and all limits."""
    clamped: dict[str, float] = {}
    while True:
        free = {s: t for s, t in targets.items() if s not in clamped and t > 0}
        rest, weight = total - sum(clamped.values()), sum(free.values())
        over = {s for s, t in free.items() if rest * t / weight >= limits.get(s, 0.0)}
        if not over:
            return {s: 0.0 for s in targets} | clamped | {s: max(0.0, rest) * t / weight for s, t in free.items()}
        clamped |= {s: limits.get(s, 0.0) for s in over}


def mix(sized: DataFrame, targets: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix and its shares.

    sized: doc_id, source, n_tokens; targets: source, target_share, max_repeats, budget_ratio. The budget is
    budget_ratio of the tokens of all documents, those of other sources included. The mix has a row per document that
    occurs in it: doc_id, source, repeats (1 to max_repeats), n_tokens. Documents of a source occur its whole number
    of epochs; the rest of its size is filled in an order seeded by `seed` and doc_id, up to the first document that
    would pass it, and then by the one document left that brings it nearest, if any does. Documents without tokens, of null sources or of sources without a target are not in the mix.
    Shares: source, target_share, feasible_share, actual_share, supply, tokens, epochs; sources without documents
    have 0. Only one row per source of the targets reaches the driver; documents of other sources count in the budget.
    """
    spark = sized.sparkSession
    goals = targets.select(source_name("source").alias("source"), "target_share", "max_repeats", "budget_ratio").where("source IS NOT NULL")
    goals = goals.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"), F.max("budget_ratio").alias("budget_ratio"))
    rows = sized.select("doc_id", source_name("source").alias("source"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")).where("n_tokens > 0")
    place = F.xxhash64(F.lit(seed), F.col("doc_id"))
    rows = rows.withColumn("slice", F.pmod(place, F.lit(SLICES)).cast("int"))
    slices = rows.groupBy("source", "slice").agg(F.sum("n_tokens").alias("tokens"))
    listed = goals.limit(SOURCES + 1).collect()
    if len(listed) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources with a target")
    wanted = F.broadcast(goals.select("source", F.lit(True).alias("listed")))
    held = slices.join(wanted, "source", "left").groupBy(F.when(F.col("listed"), F.col("source")).alias("source")).agg(F.sum("tokens").alias("tokens")).collect()
    supply = {r["source"]: r["tokens"] for r in held if r["source"] is not None}
    total = sum(r["tokens"] for r in held) * max((r["budget_ratio"] or 0.0 for r in listed), default=0.0)
    whole = sum(max(0.0, r["target_share"] or 0.0) for r in listed) or 1.0
    shares = {r["source"]: max(0.0, r["target_share"] or 0.0) / whole for r in listed}
    limits = {r["source"]: float(max(0, r["max_repeats"] or 0) * supply.get(r["source"], 0)) for r in listed}
    sizes = water_fill(shares, limits, total)
    plan = []
    for r in listed:
        have = supply.get(r["source"], 0)
        epochs = int(sizes[r["source"]] // have) if have else 0
        plan.append((r["source"], float(r["target_share"] or 0.0), sizes[r["source"]] / total if total else 0.0, have, epochs, int(round(sizes[r["source"]] - epochs * have))))
    plan = F.broadcast(spark.createDataFrame(plan, "source string, target_share double, feasible_share double, supply long, epochs int, part long"))
    # Where each slice starts in the seeded order of its source: at most SLICES rows a source.
    order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("start", F.coalesce(F.sum("tokens").over(order), F.lit(0))).join(plan, "source")
    reached = starts.where(F.col("start") < F.col("part")).groupBy("source").agg(F.max(F.struct("slice", "start")).alias("cut")).select("source", "cut.*")
    reached = F.broadcast(reached.select("source", F.col("slice").alias("last"), "start"))
    rows = rows.join(plan.select("source", "epochs", "part"), "source").join(reached, "source", "left")
    inner = Window.partitionBy("source", "slice").orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.where(F.col("slice") == F.col("last"))
    edge = edge.withColumn("extra", (F.col("start") + F.sum("n_tokens").over(inner) <= F.col("part")).cast("int"))
    rest = rows.where(F.col("last").isNull() | (F.col("slice") != F.col("last"))).withColumn("extra", F.coalesce((F.col("slice") < F.col("last")).cast("int"), F.lit(0)))
    taken = rest.unionByName(edge).select("doc_id", "source", "epochs", "part", "extra", "n_tokens", place.alias("place"))
    gap = taken.groupBy("source").agg((F.max("part") - F.sum(F.col("extra") * F.col("n_tokens"))).alias("gap")).where("gap > 0")
    apart = F.abs(F.col("gap") - F.col("n_tokens"))
    last = taken.where("extra = 0").join(F.broadcast(gap), "source").where(apart < F.col("gap"))
    last = last.groupBy("source").agg(F.min(F.struct(apart.alias("apart"), "place", "doc_id")).alias("l")).select("source", F.col("l.doc_id").alias("last_id"))
    taken = taken.join(F.broadcast(last), "source", "left").withColumn("extra", F.when(F.col("doc_id") == F.col("last_id"), 1).otherwise(F.col("extra")))
    out = taken.select("doc_id", "source", (F.col("epochs") + F.col("extra")).cast("int").alias("repeats"), "n_tokens").where("repeats > 0")
    got = out.groupBy("source").agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"))
    report = plan.join(got, "source", "left").select("source", "target_share", "feasible_share", "supply", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    everything = F.sum("tokens").over(Window.partitionBy(F.lit(0).alias("_all")))  # a row per source
    report = report.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(everything, F.lit(0)), F.lit(0.0)))
    return out, report.withColumn("epochs", F.coalesce(F.col("tokens") / F.nullif(F.col("supply"), F.lit(0)), F.lit(0.0)))
