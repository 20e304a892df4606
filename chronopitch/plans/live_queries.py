"""The live cycle read off the driver's domain tables: schedule, acquisition, identity gates, outcomes, recovery, read services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronopitch.operators import acquire, asof, tasks
from chronopitch.plans.domain import LEDGER, ledger
from chronopitch.session import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def micros(c: str) -> F.Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


_FIXTURES = """fx AS (SELECT fixture_id, arg_max(kickoff_at, struct_pack(a := updated_at, b := row_id)) AS kickoff_at, min(knowledge_at) AS seen_at FROM live_fixture WHERE kickoff_at IS NOT NULL AND updated_at IS NOT NULL GROUP BY fixture_id)"""
_PLAN = ", ".join(f"('{c}', '{h}', {tasks.OFFSETS[h]})" for c, own in tasks.PLAN.items() for h in own)


def _fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "live_fixture").where("kickoff_at IS NOT NULL AND updated_at IS NOT NULL")
    return rows.groupBy("fixture_id").agg(F.max_by("kickoff_at", F.struct("updated_at", "row_id")).alias("kickoff_at"), F.min("knowledge_at").alias("seen_at"))


@query(f"""WITH {_FIXTURES}, p(capability, horizon, minutes) AS (VALUES {_PLAN}),
a AS (SELECT fixture_id, capability, horizon, epoch_us(kickoff_at) - CAST(minutes AS BIGINT) * 60000000 AS scheduled_us, epoch_us(kickoff_at) AS k FROM fx, p
      UNION ALL SELECT fixture_id, 'fixture', 'first_observed', epoch_us(seen_at), epoch_us(kickoff_at) FROM fx WHERE seen_at IS NOT NULL)
SELECT fixture_id, capability, horizon, scheduled_us FROM a WHERE scheduled_us <= k""")
def horizon_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every task of a fixture, 27 where it was first observed before kick-off."""
    out = tasks.plan(_fixtures(spark, sf_dir))
    return out.select("fixture_id", "capability", "horizon", micros("scheduled_for").alias("scheduled_us"))


@query(f"""WITH {LEDGER}, a AS (SELECT *, state = 'success' AS ok FROM ledger)
SELECT fixture_id, capability, count(*) AS attempts, count(*) FILTER (WHERE ok) AS successful_attempts, count(*) FILTER (WHERE NOT ok) AS failed_attempts, count(DISTINCT CASE WHEN ok THEN entry_id END) AS evidence,
  arg_max(source, struct_pack(a := knowledge_at, b := entry_id)) AS final_source, CASE WHEN arg_max(ok, struct_pack(a := knowledge_at, b := entry_id)) THEN 'canonical_persisted' ELSE 'failed' END AS status FROM a GROUP BY ALL""")
def acquisition_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: one run row from all its attempts, by its last attempt's outcome."""
    rows = ledger(spark, sf_dir).withColumn("ok", F.col("state") == "success")
    return acquire.runs(rows, ["fixture_id", "capability"], F.struct("knowledge_at", "entry_id"), F.when(F.col("ok"), F.col("entry_id")))


@query("""WITH e AS (SELECT DISTINCT entry_id, source, capability, evidence_id, state, payload FROM ledger_entry WHERE entry_id IS NOT NULL),
i AS (SELECT *, unnest(list_filter([CASE WHEN payload IS NULL THEN 'no_payload' END, CASE WHEN evidence_id IS NULL THEN 'no_evidence' END, CASE WHEN state = 'success' AND payload IS NOT NULL AND NOT (json_valid(payload) AND json_type(payload) = 'OBJECT') THEN 'schema_drift' END], lambda x: x IS NOT NULL)) AS code FROM e)
SELECT DISTINCT sha256('quarantine|' || entry_id || '|' || coalesce(evidence_id, '') || '|' || coalesce(capability, '') || '|' || code) AS quarantine_id, entry_id, coalesce(source, 'unknown') AS source, code FROM i""")
def quarantine_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarantine row per issue, its id made of what it is about, so a replay writes the same rows."""
    rows = table(spark, sf_dir, "ledger_entry").where("entry_id IS NOT NULL").select("entry_id", "source", "capability", "evidence_id", "state", "payload").distinct()
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"), F.lit(False))
    checks = {"no_payload": F.col("payload").isNull(), "no_evidence": F.col("evidence_id").isNull(), "schema_drift": (F.col("state") == "success") & F.col("payload").isNotNull() & ~whole}
    return acquire.quarantine(rows, checks, ["entry_id", "evidence_id", "capability"]).select("quarantine_id", "entry_id", F.coalesce("source", F.lit("unknown")).alias("source"), "code").distinct()


@query("""SELECT DISTINCT entry_id, sha256(coalesce(payload, '{"error":"' || state || '","state":"' || state || '"}')) AS content_hash, payload IS NULL AS is_error FROM ledger_entry WHERE entry_id IS NOT NULL AND state IS NOT NULL""")
def evidence_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of every attempt; one without a payload keeps its error and state as the payload."""
    rows = table(spark, sf_dir, "ledger_entry").where("entry_id IS NOT NULL AND state IS NOT NULL")
    return rows.select("entry_id", F.sha2(acquire.evidence_payload(F.col("payload"), F.col("state"), F.col("state")), 256).alias("content_hash"), F.col("payload").isNull().alias("is_error")).distinct()


@query(f"""WITH {LEDGER}, r AS (SELECT capability, source, dense_rank() OVER (PARTITION BY capability ORDER BY source) AS place FROM (SELECT DISTINCT capability, source FROM ledger)),
m AS (SELECT capability, max(place) AS last FROM r GROUP BY capability)
SELECT entry_id, r.place, k % 4 AS observations, k % 4 > 0 OR r.place = m.last AS accepted FROM ledger l JOIN r ON r.capability = l.capability AND r.source = l.source JOIN m ON m.capability = l.capability""")
def semantic_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: an empty result is taken from the last source in order only."""
    rows = ledger(spark, sf_dir).withColumn("observations", F.pmod("k", F.lit(4)))
    order = rows.select("capability", "source").distinct().withColumn("place", F.dense_rank().over(Window.partitionBy("capability").orderBy("source")))
    order = order.withColumn("last", F.max("place").over(Window.partitionBy("capability")))
    out = rows.join(F.broadcast(order), ["capability", "source"])  # a row per capability and source
    return out.select("entry_id", "place", "observations", acquire.accepts(F.col("observations"), F.col("place"), F.col("last")).alias("accepted"))


@query("""WITH m AS (SELECT fixture_id, source, CASE WHEN count(DISTINCT provider_entity_id) = 1 THEN min(provider_entity_id) END AS mapped FROM ledger_entry WHERE provider_entity_id IS NOT NULL AND fixture_id IS NOT NULL GROUP BY ALL),
t AS (SELECT DISTINCT task_id, lower(trim(fixture_id)) AS fixture_id, coalesce(source, 'goalstat') AS source, 'goalstat' AS main FROM observation_task),
q AS (SELECT t.*, m.mapped, p.mapped AS own FROM t LEFT JOIN m ON m.fixture_id = t.fixture_id AND m.source = t.source LEFT JOIN m p ON p.fixture_id = t.fixture_id AND p.source = t.main)
SELECT task_id, source, CASE WHEN source = main THEN own ELSE mapped END AS provider_id, CASE WHEN source <> main AND mapped IS NULL THEN 'no_adjudicated_id' WHEN source = main AND own IS NULL THEN 'no_provider_id' END AS refused FROM q""")
def provider_id_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fallback source is asked by its own mapped id, never by the main source's; without one it is refused."""
    seen = table(spark, sf_dir, "ledger_entry").where("provider_entity_id IS NOT NULL AND fixture_id IS NOT NULL")
    mapping = seen.groupBy("fixture_id", "source").agg(F.when(F.count_distinct("provider_entity_id") == 1, F.min("provider_entity_id")).alias("mapped"))
    asked = table(spark, sf_dir, "observation_task").select("task_id", F.lower(F.trim("fixture_id")).alias("fixture_id"), F.coalesce("source", F.lit("goalstat")).alias("source")).distinct()
    return acquire.translated(asked, mapping, "goalstat").select("task_id", "source", "provider_id", "refused")


@query("""WITH e AS (SELECT DISTINCT entry_id, fixture_id, source, provider_entity_id FROM ledger_entry WHERE provider_entity_id IS NOT NULL),
m AS (SELECT fixture_id, source, arg_min(provider_entity_id, struct_pack(n := -n, p := provider_entity_id)) AS asked FROM (SELECT fixture_id, source, provider_entity_id, count(*) AS n FROM e GROUP BY ALL) GROUP BY ALL)
SELECT e.entry_id, e.provider_entity_id FROM e JOIN m ON m.fixture_id = e.fixture_id AND m.source = e.source AND m.asked = e.provider_entity_id""")
def neighbour_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of what a source returned for a fixture, only the rows of the provider id that was asked for."""
    rows = table(spark, sf_dir, "ledger_entry").where("provider_entity_id IS NOT NULL").select("entry_id", "fixture_id", "source", "provider_entity_id").distinct()
    usual = rows.groupBy("fixture_id", "source", "provider_entity_id").count().groupBy("fixture_id", "source").agg(F.min_by("provider_entity_id", F.struct(-F.col("count"), F.col("provider_entity_id"))).alias("provider_entity_id"))
    return rows.join(usual, ["fixture_id", "source", "provider_entity_id"], "left_semi").select("entry_id", "provider_entity_id")


@query("""WITH t AS (SELECT DISTINCT task_id, lower(trim(fixture_id)) AS f, capability, scheduled_for FROM observation_task),
e AS (SELECT DISTINCT entry_id, lower(trim(fixture_id)) AS f, capability, knowledge_at, payload FROM ledger_entry WHERE state = 'success' AND NOT operational_probe),
r AS (SELECT t.task_id, t.f, e.entry_id, e.payload, row_number() OVER (PARTITION BY t.task_id ORDER BY e.knowledge_at DESC, e.entry_id) AS n FROM t JOIN e ON t.f = e.f AND t.capability = e.capability AND e.knowledge_at <= t.scheduled_for),
b AS (SELECT lower(trim(fixture_id)) AS f, arg_max(home_goals, struct_pack(a := updated_at, b := row_id)) AS home_goals, arg_max(away_goals, struct_pack(a := updated_at, b := row_id)) AS away_goals FROM live_fixture WHERE updated_at IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL GROUP BY 1)
SELECT r.task_id, r.entry_id, coalesce(TRY_CAST(json_extract_string(payload, '$.score.home') AS INTEGER), b.home_goals) AS home_goals, coalesce(TRY_CAST(json_extract_string(payload, '$.score.away') AS INTEGER), b.away_goals) AS away_goals FROM r LEFT JOIN b ON b.f = r.f WHERE n = 1""")
def fixture_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixture as one ledger entry knew it, its payload laid over the base row."""
    from chronopitch.plans.data_queries import p4_found

    found = p4_found(spark, sf_dir)
    told = table(spark, sf_dir, "ledger_entry").where("state = 'success'").groupBy("entry_id").agg(F.min("payload").alias("payload"))
    asked = table(spark, sf_dir, "observation_task").select("task_id", asof.same_key("fixture_id").alias("f")).distinct()
    base = table(spark, sf_dir, "live_fixture").where("updated_at IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL").groupBy(asof.same_key("fixture_id").alias("f"))
    base = base.agg(F.max_by(F.struct("home_goals", "away_goals"), F.struct("updated_at", "row_id")).alias("b"))
    score = lambda s: F.coalesce(F.get_json_object("payload", f"$.score.{s}").try_cast("int"), F.col(f"b.{s}_goals")).alias(f"{s}_goals")
    return found.join(told, "entry_id").join(asked, "task_id").join(base, "f", "left").select("task_id", "entry_id", score("home"), score("away"))


@query("""WITH e AS (SELECT DISTINCT entry_id, fixture_id, capability, source, state, knowledge_at FROM ledger_entry WHERE knowledge_at IS NOT NULL AND fixture_id IS NOT NULL),
p AS (SELECT *, lag(source) OVER w AS before, lag(state) OVER w AS before_state FROM e WINDOW w AS (PARTITION BY fixture_id, capability ORDER BY knowledge_at, entry_id))
SELECT entry_id, before AS failed_source, source AS served_by, 'fallback_activated' AS marker FROM p WHERE state = 'success' AND before <> source AND before_state <> 'success'""")
def fallback_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker where a source serves right after another failed; the schedule-wide fixture is one window among the others."""
    rows = table(spark, sf_dir, "ledger_entry").where("knowledge_at IS NOT NULL AND fixture_id IS NOT NULL").select("entry_id", "fixture_id", "capability", "source", "state", "knowledge_at").distinct()
    w = Window.partitionBy("fixture_id", "capability").orderBy("knowledge_at", "entry_id")
    rows = rows.withColumns({"failed_source": F.lag("source").over(w), "_state": F.lag("state").over(w)}).where("state = 'success' AND failed_source <> source AND _state <> 'success'")
    return rows.select("entry_id", "failed_source", F.col("source").alias("served_by"), F.lit("fallback_activated").alias("marker"))


@query("""WITH m AS (SELECT source, capability, CAST(knowledge_at AS DATE) AS day, count(DISTINCT entry_id) AS n FROM ledger_entry WHERE knowledge_at IS NOT NULL GROUP BY ALL)
SELECT sha256(coalesce(source, '') || '|' || coalesce(capability, '') || '|' || CAST(n AS VARCHAR)) AS measurement_id, count(*) AS saved_times, min(day) AS first_day FROM m GROUP BY 1""")
def measurement_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measurement's id leaves out when it was made, so the same measurement is saved once."""
    m = table(spark, sf_dir, "ledger_entry").where("knowledge_at IS NOT NULL").groupBy("source", "capability", F.to_date("knowledge_at").alias("day")).agg(F.count_distinct("entry_id").alias("n"))
    key = F.sha2(F.concat_ws("|", F.coalesce("source", F.lit("")), F.coalesce("capability", F.lit("")), F.col("n").cast("string")), 256)
    return m.groupBy(key.alias("measurement_id")).agg(F.count("*").alias("saved_times"), F.min("day").alias("first_day"))


@query("""WITH t AS (SELECT task_id, min(lower(trim(fixture_id))) AS f, min(capability) AS capability, min(scheduled_for) AS due_at FROM observation_task GROUP BY task_id),
e AS (SELECT DISTINCT lower(trim(fixture_id)) AS f, capability, knowledge_at FROM ledger_entry WHERE state = 'success')
SELECT sha256('missed|' || task_id) AS outcome_id, task_id FROM t WHERE due_at + INTERVAL 15 MINUTE < TIMESTAMPTZ '2025-01-01 00:00:00+00' AND NOT EXISTS (SELECT 1 FROM e WHERE e.f = t.f AND e.capability = t.capability AND e.knowledge_at BETWEEN t.due_at AND t.due_at + INTERVAL 15 MINUTE)""")
def mark_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Due tasks without an outcome in their window are missed; the id is the task's, so marking twice adds nothing."""
    t = table(spark, sf_dir, "observation_task").groupBy("task_id").agg(F.min(asof.same_key("fixture_id")).alias("f"), F.min("capability").alias("capability"), F.min("scheduled_for").alias("at"))
    e = table(spark, sf_dir, "ledger_entry").where("state = 'success'").select(asof.same_key("fixture_id").alias("entity_f"), F.col("capability").alias("c"), F.col("knowledge_at").cast("timestamp").alias("known_at"))
    # The last success by the window's end is in the window or none is: an as-of lookup instead of a range join.
    end = F.col("at").cast("timestamp") + F.expr("INTERVAL 15 MINUTES")
    due = t.where(end < F.lit("2025-01-01 00:00:00").cast("timestamp"))
    versions = e.select(F.concat_ws("\x1f", "entity_f", "c").alias("entity"), "known_at", F.lit("x").alias("version_id"))
    last = asof.as_known_at(due.select(F.col("task_id").alias("event_id"), F.concat_ws("\x1f", "f", "capability").alias("entity"), end.alias("at")), versions)
    hit = due.join(last, due["task_id"] == last["event_id"]).where(F.col("known_at") >= F.col("at").cast("timestamp")).select(due["task_id"])
    return due.join(hit, "task_id", "left_anti").select(F.sha2(F.concat(F.lit("missed|"), "task_id"), 256).alias("outcome_id"), "task_id")


@query("""WITH RECURSIVE o AS (SELECT user_id AS resource, event_id % 3 AS token, epoch_us(ts) AS t_us, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT resource, n, event_id, token AS holder, t_us + 86400000000 AS until, TRUE AS granted FROM o WHERE n = 1
  UNION ALL SELECT o.resource, o.n, o.event_id, CASE WHEN o.t_us >= f.until OR o.token = f.holder THEN o.token ELSE f.holder END, CASE WHEN o.t_us >= f.until OR o.token = f.holder THEN o.t_us + 86400000000 ELSE f.until END, o.t_us >= f.until OR o.token = f.holder FROM f JOIN o ON o.resource = f.resource AND o.n = f.n + 1)
SELECT resource, event_id, holder, until, granted FROM f""")
def lease_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who holds a lease after each claim: granted where the last one has run out or is the claimer's own."""
    claims = table(spark, sf_dir, "events").select(F.col("user_id").alias("resource"), F.pmod("event_id", F.lit(3)).alias("token"), micros("ts").alias("at"), "event_id")
    return acquire.leases(claims, 86_400_000_000)


@query("""WITH e AS (SELECT fixture_id, capability, arg_max(state, struct_pack(a := knowledge_at, b := entry_id)) AS state, min(epoch_us(knowledge_at)) AS started_us, max(epoch_us(knowledge_at)) AS updated_us, count(DISTINCT entry_id) AS events
  FROM ledger_entry WHERE knowledge_at IS NOT NULL AND fixture_id IS NOT NULL GROUP BY ALL), n AS (SELECT max(updated_us) AS now FROM e)
SELECT e.*, state <> 'success' AND updated_us < now - 604800000000 AS stale FROM e, n""")
def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run's latest state off its append-only events, and which have stood unfinished too long and are to be replayed."""
    rows = table(spark, sf_dir, "ledger_entry").where("knowledge_at IS NOT NULL AND fixture_id IS NOT NULL")
    return acquire.lifecycle(rows.withColumn("at", micros("knowledge_at")), ["fixture_id", "capability"], 604_800_000_000)


@query("""SELECT f.row_id, f.fixture_id, t.n_tasks, e.n_entries FROM live_fixture f LEFT JOIN (SELECT lower(trim(fixture_id)) AS x, count(DISTINCT task_id) AS n_tasks FROM observation_task GROUP BY 1) t ON t.x = lower(trim(f.fixture_id))
LEFT JOIN (SELECT lower(trim(fixture_id)) AS x, count(DISTINCT entry_id) AS n_entries FROM ledger_entry WHERE state = 'success' GROUP BY 1) e ON e.x = lower(trim(f.fixture_id))""")
def fixture_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures with their tasks and their entries, each side kept where the others have nothing."""
    t = table(spark, sf_dir, "observation_task").groupBy(asof.same_key("fixture_id").alias("x")).agg(F.count_distinct("task_id").alias("n_tasks"))
    e = table(spark, sf_dir, "ledger_entry").where("state = 'success'").groupBy(asof.same_key("fixture_id").alias("x")).agg(F.count_distinct("entry_id").alias("n_entries"))
    f = table(spark, sf_dir, "live_fixture").select("row_id", "fixture_id", asof.same_key("fixture_id").alias("x"))
    return f.join(t, "x", "left").join(e, "x", "left").select("row_id", "fixture_id", "n_tasks", "n_entries")


_LABELS = ("success", "source_failed", "missed_observation")


@query(f"""WITH g AS (SELECT DISTINCT source, capability FROM ledger_entry WHERE source IS NOT NULL AND capability IS NOT NULL), l(label) AS (VALUES {", ".join(f"('{x}')" for x in _LABELS)}),
n AS (SELECT source, capability, state, count(DISTINCT entry_id) AS samples FROM ledger_entry GROUP BY ALL)
SELECT g.source, g.capability, l.label, coalesce(n.samples, 0) AS samples FROM g CROSS JOIN l LEFT JOIN n ON n.source = g.source AND n.capability = g.capability AND n.state = l.label""")
def groups_with_no_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group and label has a row, with 0 where nothing was seen."""
    e = table(spark, sf_dir, "ledger_entry").where("source IS NOT NULL AND capability IS NOT NULL")
    spine = e.select("source", "capability").distinct().withColumn("label", F.explode(F.array(*map(F.lit, _LABELS))))
    n = e.groupBy("source", "capability", F.col("state").alias("label")).agg(F.count_distinct("entry_id").alias("samples"))
    return spine.join(n, ["source", "capability", "label"], "left").na.fill(0, ["samples"])


@query("""WITH e AS (SELECT DISTINCT entry_id, source_observed_at, available_at, knowledge_at FROM ledger_entry)
SELECT o.observation_id, epoch_us(coalesce(o.observed_at, o.available_at, o.knowledge_at)) AS observed_us, CASE WHEN o.observed_at IS NOT NULL THEN 'own' WHEN o.available_at IS NOT NULL THEN 'available' WHEN o.knowledge_at IS NOT NULL THEN 'known' END AS inherited FROM source_observation o""")
def chronology_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An observation without a time of its own takes the next best that its evidence has."""
    o = table(spark, sf_dir, "source_observation")
    times = [("observed_at", "own"), ("available_at", "available"), ("knowledge_at", "known")]
    which = F.when(F.lit(False), F.lit(None).cast("string"))
    for c, name in times:
        which = which.when(F.col(c).isNotNull(), name)
    return o.select("observation_id", F.coalesce(*(micros(c) for c, _ in times)).alias("observed_us"), which.alias("inherited"))


_ALIASES = {"attendance": ("attendance", "Attendance", "crowd"), "venue": ("venue", "ground"), "referee": ("official", "referee")}
_GET = ", ".join("coalesce(" + ", ".join(f"json_extract_string(payload, '$.{a}')" for a in own) + f") AS {k}" for k, own in _ALIASES.items())


@query(f"""WITH e AS (SELECT entry_id, min(payload) AS payload FROM ledger_entry WHERE state = 'success' GROUP BY entry_id) SELECT entry_id, {_GET} FROM e WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'
  AND coalesce(json_type(payload, '$.venue'), '') NOT IN ('OBJECT', 'ARRAY') AND coalesce(json_type(payload, '$.ground'), '') NOT IN ('OBJECT', 'ARRAY') AND coalesce(json_type(payload, '$.attendance'), '') NOT IN ('OBJECT', 'ARRAY')
  AND coalesce(json_type(payload, '$.Attendance'), '') NOT IN ('OBJECT', 'ARRAY') AND coalesce(json_type(payload, '$.crowd'), '') NOT IN ('OBJECT', 'ARRAY') AND coalesce(json_type(payload, '$.official'), '') NOT IN ('OBJECT', 'ARRAY') AND coalesce(json_type(payload, '$.referee'), '') NOT IN ('OBJECT', 'ARRAY')""")
def alias_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field from the first of its names that a row has, where all of them hold single values."""
    e = table(spark, sf_dir, "ledger_entry").where("state = 'success'").groupBy("entry_id").agg(F.min("payload").alias("payload"))
    e = e.withColumn("v", F.try_parse_json("payload")).where(F.schema_of_variant("v").startswith("OBJECT"))
    for a in (a for own in _ALIASES.values() for a in own):
        e = e.where(~F.coalesce(F.schema_of_variant(F.try_variant_get("v", f"$.{a}", "variant")).rlike("^(OBJECT|ARRAY)"), F.lit(False)))
    return e.select("entry_id", *(F.coalesce(*(F.try_variant_get("v", f"$.{a}", "string") for a in own)).alias(k) for k, own in _ALIASES.items()))


@query("""SELECT DISTINCT e.entry_id, CASE WHEN m.source IS NULL THEN 'unknown_source' WHEN m.rights_state IS NULL OR m.rights_state NOT IN ('approved', 'allowed', 'granted', 'open') THEN 'rights' END AS refused
FROM (SELECT DISTINCT entry_id, source FROM ledger_entry WHERE entry_id IS NOT NULL) e LEFT JOIN source_manifest m ON m.source = e.source""")
def policy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest lets a source's entries do: unknown sources and missing rights are refused."""
    e = table(spark, sf_dir, "ledger_entry").where("entry_id IS NOT NULL").select("entry_id", "source").distinct()
    m = table(spark, sf_dir, "source_manifest").select("source", "rights_state", F.lit(True).alias("listed"))
    rights = F.coalesce(F.col("rights_state").isin("approved", "allowed", "granted", "open"), F.lit(False))
    return e.join(F.broadcast(m), "source", "left").select("entry_id", F.when(F.col("listed").isNull(), "unknown_source").when(~rights, "rights").alias("refused")).distinct()  # a fixed dimension


@query("""WITH v AS (SELECT fixture_id, capability, entry_id, epoch_us(knowledge_at) AS k FROM ledger_entry WHERE state = 'success' AND NOT operational_probe AND knowledge_at IS NOT NULL AND fixture_id IS NOT NULL),
c AS (SELECT fixture_id, capability, max(k) AS current_us, arg_max(entry_id, struct_pack(a := k, b := entry_id)) AS current_id FROM v GROUP BY ALL), m AS (SELECT (min(k) + max(k)) // 2 AS t FROM v),
a AS (SELECT fixture_id, capability, arg_max(entry_id, struct_pack(a := k, b := entry_id)) AS known_id FROM v, m WHERE k <= t GROUP BY ALL)
SELECT c.fixture_id, c.capability, c.current_us, c.current_id, a.known_id FROM c LEFT JOIN a ON a.fixture_id = c.fixture_id AND a.capability = c.capability""")
def read_current_and_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.12 get, current, as_known_at: each key's current version and the one known at half time, by partial aggregation."""
    v = table(spark, sf_dir, "ledger_entry").where("state = 'success' AND NOT operational_probe AND knowledge_at IS NOT NULL AND fixture_id IS NOT NULL").select("fixture_id", "capability", "entry_id", micros("knowledge_at").alias("k"))
    half = v.agg(F.expr("(min(k) + max(k)) div 2").alias("t"))
    last = lambda when: F.max(F.when(when, F.struct("k", "entry_id")))
    out = v.join(F.broadcast(half)).groupBy("fixture_id", "capability").agg(last(F.lit(True)).alias("c"), last(F.col("k") <= F.col("t")).alias("a"))  # a single row
    return out.select("fixture_id", "capability", F.col("c.k").alias("current_us"), F.col("c.entry_id").alias("current_id"), F.col("a.entry_id").alias("known_id"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY fixture_id ORDER BY updated_at DESC, row_id DESC) AS n FROM live_fixture WHERE updated_at IS NOT NULL)
SELECT DISTINCT fixture_id, provenance, freshness, source, unnest(evidence_ids) AS evidence_id FROM r WHERE n = 1""")
def fixture_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.12 provenance, B12: each fixture's latest revision with every piece of evidence behind it."""
    rows = table(spark, sf_dir, "live_fixture").where("updated_at IS NOT NULL")
    best = rows.groupBy("fixture_id").agg(F.max_by(F.struct("provenance", "freshness", "source", "evidence_ids"), F.struct("updated_at", "row_id")).alias("r"))
    return best.select("fixture_id", "r.provenance", "r.freshness", "r.source", F.explode("r.evidence_ids").alias("evidence_id")).distinct()


@query("""WITH e AS (SELECT entry_id, fixture_id, capability, epoch_us(knowledge_at) AS k FROM ledger_entry WHERE state = 'success' AND NOT operational_probe AND fixture_id IS NOT NULL AND knowledge_at IS NOT NULL)
SELECT fixture_id, capability, sha256('first|' || fixture_id || '|' || coalesce(capability, '')) AS run_id, arg_min(entry_id, struct_pack(a := k, b := entry_id)) AS entry_id, min(k) AS first_us FROM e GROUP BY fixture_id, capability""")
def first_observed_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One first-observed forecast a fixture and capability, under an id that a second run makes again."""
    e = table(spark, sf_dir, "ledger_entry").where("state = 'success' AND NOT operational_probe AND fixture_id IS NOT NULL AND knowledge_at IS NOT NULL").withColumn("k", micros("knowledge_at"))
    out = e.groupBy("fixture_id", "capability").agg(F.min(F.struct("k", "entry_id")).alias("f"))
    run = F.sha2(F.concat_ws("|", F.lit("first"), "fixture_id", F.coalesce("capability", F.lit(""))), 256)
    return out.select("fixture_id", "capability", run.alias("run_id"), F.col("f.entry_id").alias("entry_id"), F.col("f.k").alias("first_us"))


@query("""SELECT source, capability, count(DISTINCT entry_id) AS probes, count(DISTINCT CASE WHEN state = 'success' THEN entry_id END) AS passed FROM ledger_entry WHERE operational_probe GROUP BY ALL""")
def probe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes by source and capability, apart from every population of real entries."""
    return table(spark, sf_dir, "ledger_entry").where("operational_probe").groupBy("source", "capability").agg(F.count_distinct("entry_id").alias("probes"), F.count_distinct(F.when(F.col("state") == "success", F.col("entry_id"))).alias("passed"))
