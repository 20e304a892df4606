"""The queries of the problems of the core: p1, p2, p4 and p6, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.operators import asof, drift, late, timestamps
from chronopitch.session import table

KEY = ["source", "capability"]


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "ledger_entry").where(F.col("state") == "success").select("entry_id", "feed_id", "file_seq", "payload")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(_payloads(spark, sf_dir))


def p1_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.consistent_table(_payloads(spark, sf_dir))


def p1_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path-value form behind the table: each distinct entry's members at any depth, with their JSON types."""
    rows = _payloads(spark, sf_dir).groupBy("entry_id").agg(F.min("payload").alias("payload"))
    number = F.when(F.col("kind").isin(drift.WHOLE, drift.FRACTION), F.col("text").try_cast("double"))
    return drift.path_values(rows).select("entry_id", "path", "kind", number.alias("number"), F.when(F.col("kind") == drift.STRING, F.col("text")).alias("text"))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.replayed(table(spark, sf_dir, "ledger_entry").select("entry_id", *KEY, "source_observed_at", "available_at", "knowledge_at"), KEY)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir).where(F.col("outcome") != late.ON_TIME).select("entry_id", "outcome")


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.counts(_replayed(spark, sf_dir), KEY, ["string", "string"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entity = F.concat_ws("\x1f", asof.same_key("fixture_id"), F.col("capability"))
    known = F.col("fixture_id").isNotNull() & F.col("capability").isNotNull()
    tasks = table(spark, sf_dir, "observation_task").where(known).groupBy("task_id").agg(F.min_by(F.struct(entity.alias("entity"), F.col("scheduled_for").alias("at")), F.struct("created_at", "scheduled_for", "fixture_id", "capability")).alias("t"))
    entries = table(spark, sf_dir, "ledger_entry").where(known & (F.col("state") == "success") & ~F.col("operational_probe"))
    found = asof.as_known_at(
        tasks.select(F.col("task_id").alias("event_id"), "t.entity", "t.at"),
        entries.select(F.col("entry_id").alias("version_id"), entity.alias("entity"), F.col("knowledge_at").alias("known_at")),
    )
    return found.select(F.col("event_id").alias("task_id"), F.col("version_id").alias("entry_id"))


def p6_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of both tables: table_name is the row_key's first part."""
    seasons = table(spark, sf_dir, "football_data_timezone").where(F.col("match_date").isNotNull() & F.col("match_time").isNotNull())
    seasons = seasons.select(F.concat(F.lit("football_data_timezone\x1f"), F.col("row_id").cast("string")).alias("row_key"), F.lit("football_data_timezone").alias("source"), F.col("match_date").alias("text"), F.col("match_time").alias("time"), F.col("row_id").alias("place"))
    entries = table(spark, sf_dir, "ledger_entry").where(F.col("source_updated_at").isNotNull() & F.col("entry_id").isNotNull())
    entries = entries.groupBy("entry_id").agg(F.min(F.struct("source", "source_updated_at", "knowledge_at")).alias("e"))
    entries = entries.select(F.concat(F.lit("ledger_entry\x1f"), F.col("entry_id")).alias("row_key"), "e.source", F.col("e.source_updated_at").alias("text"), F.lit(None).cast("string").alias("time"), F.unix_micros(F.col("e.knowledge_at").cast("timestamp")).alias("place"))
    return seasons.unionByName(entries)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = timestamps.to_utc(p6_rows(spark, sf_dir), table(spark, sf_dir, "source_manifest")).where(F.col("utc_text").isNotNull())
    key = F.split("row_key", "\x1f", 2)
    return found.select(key[0].alias("table_name"), key[1].alias("row_key"), "utc_text")


QUERIES = {"p1_found": p1_found, "p1_table": p1_table, "p1_members": p1_members, "p2_found": p2_found, "p2_counts": p2_counts, "p4_found": p4_found, "p6_found": p6_found}

#: DuckDB's side of those that SQL can say.
ORACLE = {
    "p1_members": r"""
        WITH e AS (SELECT entry_id, min(payload) AS payload FROM ledger_entry WHERE state = 'success' GROUP BY entry_id),
        o AS (SELECT * FROM e WHERE json_valid(payload) AND json_type(payload) = 'OBJECT')
        SELECT entry_id, replace(substr(fullkey, 3), '"', '') AS path,
               CASE WHEN type IN ('OBJECT', 'ARRAY', 'BOOLEAN') THEN lower(type) WHEN type = 'VARCHAR' THEN 'string' WHEN type IN ('UBIGINT', 'BIGINT', 'HUGEINT') THEN 'whole' WHEN type = 'DOUBLE' THEN 'fraction' END AS kind,
               CASE WHEN type IN ('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE') THEN CAST(atom AS DOUBLE) END AS number, CASE WHEN type = 'VARCHAR' THEN json_extract_string(atom, '$') END AS text
        FROM o, json_tree(o.payload) WHERE fullkey <> '$' AND NOT contains(fullkey, '[')""",
    "p2_found": """
        WITH e AS (
          SELECT entry_id, min(knowledge_at) AS known,
                 min(coalesce(CASE WHEN source_observed_at >= TIMESTAMPTZ '1990-01-01 00:00:00+00' AND source_observed_at < TIMESTAMPTZ '9000-01-01 00:00:00+00' AND source_observed_at <= knowledge_at + INTERVAL 366 DAY THEN source_observed_at END,
                              CASE WHEN available_at >= TIMESTAMPTZ '1990-01-01 00:00:00+00' AND available_at < TIMESTAMPTZ '9000-01-01 00:00:00+00' AND available_at <= knowledge_at + INTERVAL 366 DAY THEN available_at END)) AS ev
          FROM ledger_entry GROUP BY entry_id),
        d AS (SELECT entry_id, epoch_us(known) AS known, (epoch_us(ev) // 86400000000 + 1) * 86400000000 AS day_end FROM e WHERE ev IS NOT NULL AND known IS NOT NULL)
        SELECT entry_id, CASE WHEN known < day_end + 172800000000 THEN 'corrects' ELSE 'dropped' END AS outcome
        FROM d WHERE known >= day_end""",
    "p2_counts": """
        WITH e AS (
          SELECT entry_id, min(source) AS source, min(capability) AS capability, epoch_us(min(knowledge_at)) AS known,
                 epoch_us(min(coalesce(CASE WHEN source_observed_at >= TIMESTAMPTZ '1990-01-01 00:00:00+00' AND source_observed_at < TIMESTAMPTZ '9000-01-01 00:00:00+00' AND source_observed_at <= knowledge_at + INTERVAL 366 DAY THEN source_observed_at END,
                              CASE WHEN available_at >= TIMESTAMPTZ '1990-01-01 00:00:00+00' AND available_at < TIMESTAMPTZ '9000-01-01 00:00:00+00' AND available_at <= knowledge_at + INTERVAL 366 DAY THEN available_at END))) AS ev
          FROM ledger_entry GROUP BY entry_id),
        d AS (SELECT *, ev // 86400000000 * 86400000000 AS start FROM e WHERE ev IS NOT NULL AND known IS NOT NULL),
        o AS (SELECT *, CASE WHEN known < start + 86400000000 THEN 0 WHEN known < start + 259200000000 THEN 1 ELSE 2 END AS outcome FROM d)
        SELECT source, capability, make_timestamptz(start) AS period_start, count(*) FILTER (WHERE outcome = 0) AS first_count, count(*) FILTER (WHERE outcome < 2) AS final_count, count(*) FILTER (WHERE outcome = 1) AS corrections,
               count(*) FILTER (WHERE outcome = 2) AS dropped, make_timestamptz(max(CASE WHEN outcome = 1 THEN known END)) AS corrected_at, min(CASE WHEN outcome = 1 THEN (ev - start) // 3600000000 END) AS first_step_replaced
        FROM o GROUP BY source, capability, start""",
    "p4_found": """
        WITH t AS (SELECT DISTINCT task_id, lower(trim(fixture_id)) AS f, capability, scheduled_for FROM observation_task),
        e AS (SELECT DISTINCT entry_id, lower(trim(fixture_id)) AS f, capability, knowledge_at FROM ledger_entry WHERE state = 'success' AND NOT operational_probe),
        r AS (SELECT t.task_id, e.entry_id, row_number() OVER (PARTITION BY t.task_id ORDER BY e.knowledge_at DESC, e.entry_id) AS n
              FROM t JOIN e ON t.f = e.f AND t.capability = e.capability AND e.knowledge_at <= t.scheduled_for)
        SELECT task_id, entry_id FROM r WHERE n = 1""",
}
