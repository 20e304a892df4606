"""Source health, fallback between sources, circuits, and coverage of what was collected."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Outcomes of an attempt by how much they weigh in a run's final state.
PRIORITY = ("failed", "schema_drift", "quarantined", "missing", "unsupported", "supported")


def health_signal(state: Column) -> Column:
    """An attempt's state as health."""
    return F.when(state.isin("success", "supported"), "HEALTHY").when(state.isin("missing", "unsupported"), "DEGRADED").otherwise("FAILED")


def source_health(signals: DataFrame, by: list[str]) -> DataFrame:
    """Per source: attempts, successes, failures, failure classes, last values, and the state; from the log itself, so
    that a replay changes nothing. signals: attempted_at, success, failure_class, latency_ms, signal_id."""
    order = F.struct("attempted_at", "signal_id")
    classes = signals.where("failure_class IS NOT NULL").groupBy(*by, "failure_class").agg(F.count("*").alias("n"))
    classes = classes.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(F.format_string("%s=%d", "failure_class", "n"))), ",").alias("failure_classes"))
    out = signals.groupBy(*by).agg(
        F.count("*").alias("attempts"), F.count_if("success").alias("successes"), F.count_if(~F.col("success")).alias("failures"), F.max("attempted_at").alias("last_attempt_at"),
        F.max(F.when(F.col("success"), F.col("attempted_at"))).alias("last_success_at"), F.max_by("latency_ms", order).alias("last_latency_ms"), F.max_by("success", order).alias("_last"),
    )
    state = F.when((F.col("successes") > 0) & (F.col("failures") > 0), "DEGRADED").when(F.col("failures") > 0, "FAILED").otherwise("HEALTHY")
    return out.join(classes, by, "left").withColumn("state", state).drop("_last")


def final_state(attempts: DataFrame, by: list[str]) -> DataFrame:
    """The state of a run: that of its weightiest attempt."""
    rank = F.array_position(F.array(*(F.lit(p) for p in PRIORITY)), F.col("state"))
    return attempts.groupBy(*by).agg(F.min(F.struct(rank.alias("rank"), F.col("state").alias("state"))).alias("s"), F.count("*").alias("attempts")).select(*by, "s.state", "attempts")


def first_supported(attempts: DataFrame, by: list[str], rank: Column, supported: Column) -> DataFrame:
    """The source that serves each request, the first in policy order that supports it; how many attempts there were, and
    how many failed at sources before it (all failures where none serves). A request's sources are few, its attempts not."""
    source = attempts.groupBy(*by, rank.alias("_rank")).agg(F.min("source").alias("source"), F.bool_or(supported).alias("ok"), F.count("*").alias("n"), F.count_if(~supported).alias("failed"))
    served = F.min(F.when(F.col("ok"), F.struct("_rank", "source")))
    out = source.groupBy(*by).agg(served.alias("s"), F.sum("n").alias("attempts"), F.collect_list(F.struct("_rank", "failed")).alias("f"))
    before = F.filter("f", lambda x: F.col("s").isNull() | (x["_rank"] < F.col("s._rank")))
    return out.select(*by, F.col("s.source").alias("source"), "attempts", F.aggregate(before, F.lit(0).cast("long"), lambda a, x: a + x["failed"]).alias("failed_before"))


def circuit(attempts: DataFrame, threshold: int = 3, cooldown_s: int = 120) -> DataFrame:
    """(attempt_id, circuit_state): the state of each key's circuit just after each attempt.

    attempts: key, attempted_at, attempt_id, success. Failures in a row open the circuit, the cool-down half-opens it,
    and a failure then opens it again. The fold streams a key's attempts in order and holds three numbers, so a key of
    any size is no memory; keys run side by side.
    """
    kind = dict(attempts.dtypes)["attempt_id"]
    rows = attempts.select(F.col("key").cast("string").alias("key"), "attempt_id", F.unix_micros(F.col("attempted_at").cast("timestamp")).alias("at"), "success")
    rows = rows.repartition("key").sortWithinPartitions("key", "at", "attempt_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, failures, opened = object(), "CLOSED", 0, 0
        for batch in batches:
            out = []
            for key, at, success in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if key != last:
                    last, state, failures, opened = key, "CLOSED", 0, 0
                if state == "OPEN" and at - opened >= cooldown_s * 1_000_000:
                    state = "HALF_OPEN"
                if success:
                    state, failures = "CLOSED", 0
                elif state == "HALF_OPEN":
                    state, opened = "OPEN", at
                else:
                    failures += 1
                    if failures >= threshold:
                        state, opened = "OPEN", at
                out.append(state)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.string())], ["attempt_id", "circuit_state"])

    return rows.mapInArrow(run, f"attempt_id {kind}, circuit_state string")


def qualification(rows: DataFrame, by: list[str], key: str, required: list[str], expected: Column) -> DataFrame:
    """How complete a source is: coverage, repeated keys, share of missing required fields."""
    missing = sum(F.col(c).isNull().cast("double") for c in required) / len(required)
    out = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("keys"), F.avg(missing).alias("missing_rate"), F.max(expected).alias("expected"))
    return out.withColumn("duplicates", F.col("n_rows") - F.col("keys")).withColumn("coverage", F.least(F.lit(1.0), F.col("keys") / F.col("expected")))


def recommendation(coverage: Column, missing: Column, duplicates: Column) -> Column:
    return F.when((coverage >= 0.95) & (missing <= 0.02) & (duplicates == 0), "primary").when((coverage >= 0.6) & (missing <= 0.2), "fallback").otherwise("reject")
