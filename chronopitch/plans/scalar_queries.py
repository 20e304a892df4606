"""Scalar normalisation, quality checks and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.operators import pit
from chronopitch.plans.domain import LEDGER, MATCHES, ledger, matches
from chronopitch.session import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_SLUG = "coalesce(nullif(regexp_replace(regexp_replace(replace(lower({0}), '&', 'and'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown')"
_WORDS = "array_to_string(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: w NOT IN ('afc', 'fc', 'cf', 'sc', 'and')), ' ')"


@query(f"""SELECT source_name, id, {_SLUG.format('label')} AS slug, {_WORDS.format('label')} AS name_key FROM (
  SELECT 'customer' AS source_name, c_custkey AS id, 'AFC ' || c_name || ' & ' || c_mktsegment AS label FROM customer UNION ALL
  SELECT 'supplier', s_suppkey, s_name || ' FC' FROM supplier UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation)""")
def slug_and_name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs and name keys."""
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source_name"), F.col("c_custkey").alias("id"), F.concat(F.lit("AFC "), "c_name", F.lit(" & "), "c_mktsegment").alias("label"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier"), "s_suppkey", F.concat("s_name", F.lit(" FC")))
    n = table(spark, sf_dir, "nation").select(F.lit("nation"), F.col("n_nationkey").cast("bigint"), "n_name")
    rows = c.union(s).union(n)
    return rows.select("source_name", "id", N.slug(F.col("label")).alias("slug"), N.name_key(F.col("label")).alias("name_key"))


@query(f"""WITH {MATCHES}, k AS (SELECT fixture_id, season, substr(season, 3, 2) || substr(season, 6, 2) AS code, CASE fixture_id % 4 WHEN 0 THEN season WHEN 1 THEN replace(season, '/', '-') WHEN 2 THEN substr(season, 3, 2) || substr(season, 6, 2) ELSE NULL END AS other FROM matches)
SELECT fixture_id, season, season AS from_code, TRUE AS same, other FROM k""")
def season_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season labels, from codes and from dates, and their equality in any written form."""
    m = matches(spark, sf_dir).select("fixture_id", "season", F.concat(F.substring("season", 3, 2), F.substring("season", 6, 2)).alias("code"))
    k = F.col("fixture_id") % 4
    m = m.withColumn("other", F.when(k == 0, F.col("season")).when(k == 1, F.replace("season", F.lit("/"), F.lit("-"))).when(k == 2, F.col("code")))
    return m.select("fixture_id", "season", N.season_from_code(F.col("code")).alias("from_code"), N.same_season(F.col("season"), F.col("other")).alias("same"), "other")


@query("""SELECT DISTINCT code FROM (SELECT CAST(o_orderkey AS BIGINT) AS k, unnest(list_transform(range(1993, 2023), lambda y: lpad(CAST(y % 100 AS VARCHAR), 2, '0') || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0'))) AS code FROM orders LIMIT 30)""")
def season_code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all seasons complete by a date."""
    return spark.range(1).select(F.explode(N.season_codes(1993, F.lit("2024-02-01").cast("date"))).alias("code"))


@query(f"""WITH k AS (SELECT o_orderkey AS fixture_id, strftime(o_orderdate, '%d/%m/%Y') AS long, strftime(o_orderdate, '%d/%m/%y') AS short, CAST(o_orderdate AS DATE) AS day, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + INTERVAL 30 MINUTE AS local FROM orders),
u AS (SELECT *, (local AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC' AS utc FROM k),
g AS (SELECT *, ((utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London') <> local AS gap, (((utc + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London') = local OR (((utc - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London') = local AS fold FROM u)
SELECT fixture_id, day AS long_date, day AS short_date, CASE WHEN NOT gap AND NOT fold THEN utc END AS kickoff_utc, gap, fold AND NOT gap AS fold FROM g""")
def london_wall_clock_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of both widths and wall clocks to UTC, with the readings of the gap and the fold marked."""
    o = table(spark, sf_dir, "orders")
    local = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(24)).cast("int"), mins=F.lit(30))).cast("timestamp_ntz")
    utc, gap, fold = N.wall_clock(local, "Europe/London")
    long, short = F.date_format("o_orderdate", "dd/MM/yyyy"), F.date_format("o_orderdate", "dd/MM/yy")
    return o.select(F.col("o_orderkey").alias("fixture_id"), N.match_date(long).alias("long_date"), N.match_date(short).alias("short_date"), utc.alias("kickoff_utc"), gap.alias("gap"), fold.alias("fold"))


@query("""SELECT row_id, TRY_CAST(floor(TRY_CAST(trim(fthg) AS DOUBLE)) AS BIGINT) AS home_goals, TRY_CAST(floor(TRY_CAST(trim(ftag) AS DOUBLE)) AS BIGINT) AS away_goals, TRY_CAST(trim(b365h) AS DOUBLE) AS home_odds,
  CASE WHEN TRY_CAST(trim(fthg) AS DOUBLE) IS NULL OR TRY_CAST(trim(ftag) AS DOUBLE) IS NULL THEN 'scheduled' ELSE 'completed' END AS status FROM football_data_timezone""")
def season_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed results of the season files; a blank score is a match to come."""
    f = table(spark, sf_dir, "football_data_timezone")
    home, away = N.safe_int(F.col("fthg")), N.safe_int(F.col("ftag"))
    return f.select("row_id", home.alias("home_goals"), away.alias("away_goals"), F.trim("b365h").try_cast("double").alias("home_odds"), F.when(home.isNull() | away.isNull(), "scheduled").otherwise("completed").alias("status"))


@query("""SELECT o_orderkey AS fixture_id, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'P' THEN 'live' ELSE 'scheduled' END AS short_family,
  CASE o_orderkey % 7 WHEN 0 THEN 'postponed' WHEN 1 THEN 'finished' WHEN 2 THEN 'live' WHEN 3 THEN 'cancelled' WHEN 4 THEN 'scheduled' WHEN 5 THEN 'delayed' ELSE 'unknown' END AS long_family FROM orders""")
def status_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status texts of two dialects by family."""
    texts = F.array(*(F.lit(t) for t in ("STATUS_POSTPONED", "Finished", "IN_PROGRESS", "Canceled", "not_started", "Delayed start", "??")))
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("fixture_id"), N.status_family(F.col("o_orderstatus")).alias("short_family"), N.status_family(F.get(texts, F.pmod("o_orderkey", F.lit(7)).cast("int"))).alias("long_family"))


@query(f"""WITH {LEDGER} SELECT entry_id, CASE WHEN state = 'success' THEN 'unknown' WHEN entry_id % 9 = 0 THEN 'provider_mapping_missing' WHEN entry_id % 9 = 1 THEN 'parser_schema_drift' WHEN entry_id % 9 = 2 THEN 'empty_response'
  WHEN entry_id % 9 = 3 THEN 'http_429' WHEN entry_id % 9 = 4 THEN 'http_4xx' WHEN entry_id % 9 = 5 THEN 'http_5xx' WHEN entry_id % 9 = 6 THEN 'timeout' WHEN entry_id % 9 = 7 THEN 'dns_failure' ELSE 'transport_library_failure' END AS failure_class FROM ledger""")
def failure_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a request stopped, by precedence."""
    k = F.pmod("entry_id", F.lit(9))
    bad = F.col("state") != "success"
    status = F.when(bad & (k == 3), 429).when(bad & (k == 4), 404).when(bad & (k == 5), 503)
    error = F.when(bad & (k == 6), "request timed out").when(bad & (k == 7), "getaddrinfo failed").when(bad & (k == 8), "boom")
    rows = ledger(spark, sf_dir)
    return rows.select("entry_id", N.failure_class(status, error, bad & (k == 1), bad & (k == 0), bad & (k == 2)).alias("failure_class"))


@query(f"""WITH {LEDGER}, {MATCHES}, s AS (SELECT fixture_id, max(knowledge_at) AS last_success, bool_or(capability = 'view') AS live FROM ledger WHERE state = 'success' GROUP BY fixture_id),
k AS (SELECT s.*, TIMESTAMP '2024-01-31 00:00:00' AS now_at, TIMESTAMP '2024-01-31 00:00:00' + to_hours(CAST(s.fixture_id % 40 AS INTEGER)) AS kickoff FROM s),
a AS (SELECT *, greatest(0, epoch_us(now_at) - epoch_us(last_success)) AS age, epoch_us(kickoff) - epoch_us(now_at) AS rest FROM k),
l AS (SELECT *, CASE WHEN rest <= 3600000000 THEN 1800000000 WHEN rest <= 21600000000 THEN 7200000000 WHEN rest <= 86400000000 THEN 21600000000 ELSE 86400000000 END AS lim FROM a)
SELECT fixture_id, CASE WHEN age <= lim THEN 'FRESH' WHEN NOT odd AND rest > 3600000000 AND age <= lim * 4 THEN 'ACCEPTABLE_CACHE' ELSE 'STALE' END AS freshness, age / 1000000.0 AS freshness_seconds FROM (SELECT *, fixture_id % 2 = 1 AS odd FROM l)""")
def freshness_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How fresh what is known of each fixture is."""
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    s = ledger(spark, sf_dir).where("state = 'success'").groupBy("fixture_id").agg(F.max(F.col("knowledge_at").cast("timestamp")).alias("last"))
    kickoff = now + F.make_dt_interval(hours=F.pmod("fixture_id", F.lit(40)).cast("int"))
    age = F.greatest(F.lit(0), F.unix_micros(now) - F.unix_micros("last")) / F.lit(1_000_000.0)
    return s.select("fixture_id", N.freshness(kickoff, F.col("last"), now, F.pmod("fixture_id", F.lit(2)) == 1).alias("freshness"), age.alias("freshness_seconds"))


@query("""SELECT entry_id, population, count(*) AS n FROM (SELECT entry_id, CASE WHEN operational_probe OR lower(source) LIKE 'smoke%' THEN 'test_smoke' WHEN horizon IS NULL THEN 'historical_reconstructed' ELSE 'prospective_true_pit' END AS population FROM ledger_entry) GROUP BY ALL""")
def population_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population of each entry; probes are never mixed in."""
    rows = table(spark, sf_dir, "ledger_entry")
    kind = F.when(F.col("horizon").isNull(), "historical_reconstructed").otherwise("prospective_true_pit")
    return rows.select("entry_id", N.population(F.col("source"), probe=F.col("operational_probe"), kind=kind).alias("population")).groupBy("entry_id", "population").agg(F.count("*").alias("n"))


@query("""SELECT task_id, horizon AS horizon_key, CASE horizon WHEN 't-72h' THEN 259200 WHEN 't-24h' THEN 86400 WHEN 't-6h' THEN 21600 WHEN 't-1h' THEN 3600 WHEN 't-15m' THEN 900 END AS offset_s FROM (SELECT DISTINCT task_id, horizon FROM observation_task)""")
def horizon_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizons in any written form, and their offsets."""
    rows = table(spark, sf_dir, "observation_task").select("task_id", "horizon").distinct()
    written = F.when(F.hash("task_id") % 3 == 0, F.upper(F.replace("horizon", F.lit("-"), F.lit("_")))).when(F.hash("task_id") % 3 == 1, F.concat(F.lit(" "), "horizon")).otherwise(F.col("horizon"))
    key = N.horizon(written)
    offset = F.get(F.array(*(F.lit(v) for v in N.HORIZONS.values())), F.array_position(F.array(*(F.lit(h) for h in N.HORIZONS)), F.col("horizon_key")).cast("int") - 1)
    return rows.select("task_id", key.alias("horizon_key")).withColumn("offset_s", F.when(F.col("horizon_key").isin(*N.HORIZONS), offset))


@query("""SELECT doc_id, 'ev-' || substr(sha256('=' || CAST(doc_id AS VARCHAR) || chr(31) || coalesce('=' || source, '-')), 1, 20) AS evidence_id FROM documents""")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by content."""
    return table(spark, sf_dir, "documents").select("doc_id", N.content_id("ev-", F.col("doc_id"), F.col("source"), length=20).alias("evidence_id"))


@query("""SELECT row_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(evidence_ids, []), ['ev-' || coalesce(source, 'none')]))), ',') AS evidence FROM live_fixture""")
def evidence_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence ids, united, each once, in order."""
    return table(spark, sf_dir, "live_fixture").select("row_id", F.array_join(N.evidence_union(F.col("evidence_ids"), F.array(F.concat(F.lit("ev-"), F.coalesce("source", F.lit("none"))))), ",").alias("evidence"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, array_to_string(list_filter([CASE WHEN l_quantity > 45 THEN 'too_many' END, CASE WHEN l_discount > 0.09 THEN 'discount' END, CASE WHEN l_tax IS NULL THEN 'no_tax' END], lambda x: x IS NOT NULL), ',') AS codes
FROM lineitem WHERE l_quantity > 45 OR l_discount > 0.09""")
def violations_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a check, with the codes of all checks they break."""
    found = pit.violations({"too_many": F.col("l_quantity") > 45, "discount": F.col("l_discount") > 0.09, "no_tax": F.col("l_tax").isNull()})
    rows = table(spark, sf_dir, "lineitem").withColumn("c", found).where(F.size("c") > 0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.array_join("c", ",").alias("codes"))


@query("""SELECT entry_id, code, count(*) AS n FROM (SELECT entry_id, unnest(list_filter([CASE WHEN knowledge_at > created_at THEN 'known_after_created' END, CASE WHEN knowledge_at > processing_at THEN 'known_after_processed' END,
  CASE WHEN source_observed_at > available_at THEN 'observed_after_available' END, CASE WHEN state = 'success' AND evidence_id IS NULL THEN 'success_without_evidence' END, CASE WHEN state = 'missed_observation' AND evidence_id IS NOT NULL THEN 'missed_with_evidence' END], lambda x: x IS NOT NULL)) AS code FROM ledger_entry) GROUP BY ALL""")
def ledger_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: what ledger entries break of their time order and evidence rules."""
    rows = table(spark, sf_dir, "ledger_entry").select("entry_id", F.explode(pit.violations(pit.ledger_checks())).alias("code"))
    return rows.groupBy("entry_id", "code").agg(F.count("*").alias("n"))


@query("""SELECT entry_id, min(CASE WHEN state <> 'success' THEN 'UNSUPPORTED' WHEN json_extract(payload, '$.score') IS NULL AND json_extract(payload, '$.formation') IS NULL THEN 'SCHEMA_DRIFT' WHEN json_extract_string(payload, '$.attendance') IS NULL THEN 'MISSING' ELSE 'SUPPORTED' END) AS validation FROM ledger_entry GROUP BY entry_id""")
def payload_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: the state of a payload by the fields it must have."""
    v = F.try_parse_json("payload")
    has = lambda p: F.try_variant_get(v, p, "variant").isNotNull()
    text = F.try_variant_get(v, "$.attendance", "string")
    state = F.when(F.col("state") != "success", "UNSUPPORTED").when(~has("$.score") & ~has("$.formation"), "SCHEMA_DRIFT").when(text.isNull(), "MISSING").otherwise("SUPPORTED")
    return table(spark, sf_dir, "ledger_entry").groupBy("entry_id").agg(F.min(state).alias("validation"))


@query("""SELECT doc_id, regexp_matches(lower(coalesce(text, '')), 'captcha|access denied|just a moment|challenge-platform') AS challenged, replace(regexp_extract(coalesce(text, ''), '\\{"xg":([0-9.]+)', 1), ' ', '') AS xg FROM documents""")
def challenge_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are challenges instead of content, and JSON embedded in text."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(text).rlike("captcha|access denied|just a moment|challenge-platform").alias("challenged"), F.regexp_extract(text, r'\{"xg":([0-9.]+)', 1).alias("xg"))


@query("""SELECT event_id, 'https://feed.example/e?id=' || CAST(event_id AS VARCHAR) || '&key=***&x=1' AS url, CAST(event_id AS VARCHAR) AS recovered FROM events""")
def redacted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs without secrets, and the event id found in one."""
    url = F.concat(F.lit("https://feed.example/e?id="), F.col("event_id").cast("string"), F.lit("&key=s3cr3t&x=1"))
    return table(spark, sf_dir, "events").select("event_id", N.redacted(url).alias("url"), F.regexp_extract(url, r"[?&]id=(\d+)", 1).alias("recovered"))


@query("""SELECT canonical_id, entity_type, record_id, key AS field, value FROM (SELECT canonical_id, entity_type, record_id, unnest(map_entries(json_transform(CASE WHEN json_valid(attributes) AND json_type(attributes) = 'OBJECT' THEN attributes END, '"MAP(VARCHAR, VARCHAR)"'))) AS e FROM canonical_entities), LATERAL (SELECT e.key AS key, e.value AS value)""")
def json_payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open attributes flattened into rows; what is no JSON object gives none."""
    rows = table(spark, sf_dir, "canonical_entities")
    members = F.expr("map_entries(try_variant_get(try_parse_json(attributes), '$', 'map<string,string>'))")
    return rows.select("canonical_id", "entity_type", "record_id", F.explode(members).alias("e")).select("canonical_id", "entity_type", "record_id", F.col("e.key").alias("field"), F.col("e.value").alias("value"))


@query(f"""WITH {MATCHES} SELECT fixture_id, 'fixture:epl:' || season || ':team-' || CAST(home_team AS VARCHAR) || ':team-' || CAST(away_team AS VARCHAR) AS canonical_id, 'of-' || substr(sha256('=' || CAST(CAST(kickoff_at AS DATE) AS VARCHAR) || chr(31) || '=' || CAST(home_team AS VARCHAR) || chr(31) || '=' || CAST(away_team AS VARCHAR)), 1, 24) AS derived_id FROM matches""")
def fixture_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1.7: ids of fixtures by season and teams, and derived ids of sources that have none."""
    m = matches(spark, sf_dir)
    team = lambda c: N.slug(F.concat(F.lit("Team "), F.col(c).cast("string")))
    return m.select("fixture_id", F.concat_ws(":", F.lit("fixture:epl"), "season", team("home_team"), team("away_team")).alias("canonical_id"), N.content_id("of-", F.col("kickoff_at").cast("date"), F.col("home_team"), F.col("away_team"), length=24).alias("derived_id"))
