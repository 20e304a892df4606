"""Acquisition off an attempts log: run rows, quarantine, evidence, acceptance, id translation, leases, life cycles."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def runs(attempts: DataFrame, key: list[str], order: Column, evidence: Column) -> DataFrame:
    """One row a run: its attempts by outcome, its distinct evidence, and the status its last attempt leaves.

    attempts: the key, source, ok. Groups of any size are reduced by partial aggregation.
    """
    last = F.max_by(F.struct("source", "ok"), order)
    out = attempts.withColumn("_evidence", evidence).groupBy(*key).agg(
        F.count("*").alias("attempts"), F.count_if("ok").alias("successful_attempts"), F.count_if(~F.col("ok")).alias("failed_attempts"),
        F.count_distinct("_evidence").alias("evidence"), last.alias("_last"),
    )
    status = F.when(F.col("_last.ok"), "canonical_persisted").otherwise("failed")
    return out.select(*key, "attempts", "successful_attempts", "failed_attempts", "evidence", F.col("_last.source").alias("final_source"), status.alias("status"))


def quarantine(rows: DataFrame, checks: dict[str, Column], about: list[str]) -> DataFrame:
    """A row per broken check (a null check is not broken), its id a hash of what it is about and the code."""
    codes = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(code)) for code, bad in checks.items())))
    out = rows.withColumn("code", F.explode(codes))
    text = F.concat_ws("|", F.lit("quarantine"), *(F.coalesce(F.col(c), F.lit("")) for c in about), "code")
    return out.withColumn("quarantine_id", F.sha2(text, 256))


def evidence_payload(payload: Column, error: Column, state: Column) -> Column:
    """What is kept of an attempt: its payload, or its error and state where there is none."""
    return F.coalesce(payload, F.to_json(F.struct(error.alias("error"), state.alias("state"))))


def accepts(observations: Column, place: Column, last: Column) -> Column:
    """A result with observations is taken; an empty one from the last source in order only."""
    return (observations > 0) | (place == last)


def translated(requests: DataFrame, mapping: DataFrame, main: str) -> DataFrame:
    """Each request with the id its source knows the fixture by, or why it is refused.

    requests: fixture_id, source; mapping: fixture_id, source, mapped (null where sources disagree on it). The main
    source's id is never passed on to another source.
    """
    out = requests.join(mapping.select("fixture_id", "source", "mapped"), ["fixture_id", "source"], "left").withColumnRenamed("mapped", "provider_id")
    why = F.when((F.col("source") != main) & F.col("provider_id").isNull(), "no_adjudicated_id").when(F.col("provider_id").isNull(), "no_provider_id")
    return out.withColumn("refused", why)


def leases(claims: DataFrame, length: int) -> DataFrame:
    """(resource, event_id, holder, until, granted): who holds a resource's lease after each claim, in order of time and id.

    claims: resource, token, at (long), event_id. A claim is granted where the lease has run out or is the claimer's own.
    A resource's claims are streamed through one task that holds one lease, never the claims.
    """
    kind = dict(claims.dtypes)
    line = claims.select("resource", "event_id", "token", "at").repartition("resource").sortWithinPartitions("resource", "at", "event_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource, holder, until = object(), None, None
        for batch in batches:
            out = []
            for r, token, at in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if r != resource:
                    resource, holder, until = r, None, None
                granted = until is None or at >= until or token == holder
                if granted:
                    holder, until = token, at + length
                out.append((holder, until, granted))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((batch.column(2).type, pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["resource", "event_id", "holder", "until", "granted"])

    return line.mapInArrow(run, f"resource {kind['resource']}, event_id {kind['event_id']}, holder {kind['token']}, until long, granted boolean")


def lifecycle(events: DataFrame, key: list[str], stale_after: int) -> DataFrame:
    """Each run's latest state, its first and last event, and whether it has stood unfinished for longer than allowed.

    events: the key, entry_id, state, at (long).
    """
    out = events.groupBy(*key).agg(
        F.max(F.struct("at", "entry_id", "state")).alias("_l"), F.min("at").alias("started_us"), F.max("at").alias("updated_us"), F.count_distinct("entry_id").alias("events")
    )
    now = events.agg(F.max("at").alias("_now"))
    out = out.join(F.broadcast(now))  # a single row
    return out.select(*key, F.col("_l.state").alias("state"), "started_us", "updated_us", "events", ((F.col("_l.state") != "success") & (F.col("updated_us") < F.col("_now") - stale_after)).alias("stale"))
