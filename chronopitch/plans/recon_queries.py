"""Dedup, identity, matching, and the semantics of writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.functions import normalize as N
from chronopitch.operators import reconcile as R
from chronopitch.operators import sinks as K
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


_LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("""SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_linestatus = 'F' DESC, l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS n FROM lineitem) WHERE n = 1""")
def dedup_keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a key, the last complete one first."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_linestatus")
    return R.keep_best(rows, ["l_orderkey", "l_linenumber"], F.col("l_linestatus") == "F", F.col("l_shipdate"), F.col("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")).drop("l_linestatus")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows, array_to_string(list_filter([CASE WHEN count(DISTINCT l_partkey) > 1 THEN 'l_partkey' END, CASE WHEN count(DISTINCT l_quantity) > 1 THEN 'l_quantity' END, CASE WHEN count(DISTINCT l_shipdate) > 1 THEN 'l_shipdate' END], lambda x: x IS NOT NULL), ',') AS differing,
  CASE WHEN count(DISTINCT l_partkey) = 1 AND count(DISTINCT l_quantity) = 1 THEN 'schedule_revision' ELSE 'source_conflict' END AS classification
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_partkey) > 1 OR count(DISTINCT l_quantity) > 1 OR count(DISTINCT l_shipdate) > 1""")
def dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose rows differ, and in what."""
    found = R.conflicts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_quantity", "l_shipdate"])
    kind = F.when(F.col("differing") == F.array(F.lit("l_shipdate")), "schedule_revision").otherwise("source_conflict")
    return found.select("l_orderkey", "l_linenumber", "n_rows", F.array_join("differing", ",").alias("differing"), kind.alias("classification"))


@query("""SELECT content_hash, min(doc_id) AS first_doc, max(length(text)) AS size, count(*) AS captures FROM (SELECT *, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL) GROUP BY content_hash""")
def evidence_content_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct payload once, under its hash."""
    payloads, _ = K.evidence_store(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return payloads.select("content_hash", F.col("first_capture.doc_id").alias("first_doc"), F.col("size").cast("bigint").alias("size"), "captures")


@query("""SELECT doc_id, sha256(text) AS content_hash, substr(sha256(text), 1, 2) || '/' || sha256(text) AS object_path FROM documents WHERE text IS NOT NULL""")
def evidence_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a manifest row per capture."""
    return K.evidence_store(table(spark, sf_dir, "documents"), "text", ["doc_id"])[1]


@query("""SELECT m.doc_id, m.doc_id % 50 = 0 AS gone FROM documents m WHERE m.text IS NOT NULL AND (m.doc_id % 50 = 0 OR m.doc_id % 70 = 1)""")
def evidence_replay_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures whose payload is gone, or no longer what it was."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text").alias("payload"))
    manifests = docs.select("doc_id", F.sha2("payload", 256).alias("content_hash"))
    stored = docs.where("doc_id % 50 != 0").select(F.sha2("payload", 256).alias("content_hash"), F.when(F.col("doc_id") % 70 == 1, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")).alias("payload"))
    return K.replay_checks(manifests, stored).select("doc_id", (F.col("doc_id") % 50 == 0).alias("gone"))


@query(f"""WITH {MATCHES}, a AS (SELECT fixture_id AS sid, home_team, away_team, season, kickoff_at + to_hours(CAST(fixture_id % 50 AS INTEGER)) AS k FROM matches WHERE status = 'completed'),
b AS (SELECT fixture_id AS cid, home_team, away_team, season, kickoff_at AS k FROM matches WHERE fixture_id % 3 <> 0),
p AS (SELECT sid, cid, abs(epoch_us(a.k) - epoch_us(b.k)) AS d FROM a JOIN b USING (home_team, away_team) WHERE abs(epoch_us(a.k) - epoch_us(b.k)) <= 129600000000 AND a.season = b.season),
c AS (SELECT sid, count(*) AS n, min(d) AS d, arg_min(cid, struct_pack(x := d, y := cid)) AS nearest FROM p GROUP BY sid)
SELECT a.sid AS source_fixture_id, coalesce(c.n, 0) AS candidates, CASE WHEN c.n IS NULL THEN 'unresolved' WHEN c.n = 1 THEN 'confirmed' ELSE 'ambiguous' END AS status, c.nearest, c.d / 60000000.0 AS delta_minutes FROM a LEFT JOIN c ON a.sid = c.sid""")
def fixture_match_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures of a source matched by teams, season and kick-off within 36 hours."""
    m = matches(spark, sf_dir)
    moved = (F.col("kickoff_at").cast("timestamp") + F.make_dt_interval(hours=F.pmod("fixture_id", F.lit(50)).cast("int"))).cast("timestamp_ntz")
    ours = m.where("status = 'completed'").select(F.col("fixture_id").alias("source_fixture_id"), "home_team", "away_team", "season", moved.alias("kickoff_at"))
    theirs = m.where("fixture_id % 3 != 0").select(F.col("fixture_id").alias("canonical_fixture_id"), "home_team", "away_team", "season", "kickoff_at")
    return R.match_fixtures(ours, theirs)


@query("""WITH r AS (SELECT c_custkey AS row_no, c_mktsegment AS source, c_nationkey AS source_id FROM customer),
e AS (SELECT DISTINCT 'BUILDING' AS source, s_nationkey AS source_id, 'x-' || CAST(s_nationkey AS VARCHAR) AS canonical_id FROM supplier WHERE s_nationkey % 2 = 0),
s AS (SELECT DISTINCT 'MACHINERY' AS source, s_nationkey AS source_id, 's-' || CAST(s_nationkey AS VARCHAR) AS canonical_id FROM supplier),
i AS (SELECT n_nationkey AS source_id, 'n-' || n_name AS canonical_id FROM nation WHERE n_regionkey <> 3)
SELECT row_no, r.source, r.source_id, coalesce(e.canonical_id, s.canonical_id, i.canonical_id) AS canonical_id, CASE WHEN e.canonical_id IS NOT NULL THEN 'explicit' WHEN s.canonical_id IS NOT NULL THEN 'source' WHEN i.canonical_id IS NOT NULL THEN 'id' ELSE 'unresolved' END AS resolved_by
FROM r LEFT JOIN e ON r.source = e.source AND r.source_id = e.source_id LEFT JOIN s ON r.source = s.source AND r.source_id = s.source_id LEFT JOIN i ON r.source_id = i.source_id""")
def identity_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by explicit map, then source and id, then id."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_no"), F.col("c_mktsegment").alias("source"), F.col("c_nationkey").alias("source_id"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("source_id"))
    number = F.col("source_id").cast("string")
    explicit = s.where("source_id % 2 = 0").select(F.lit("BUILDING").alias("source"), "source_id", F.concat(F.lit("x-"), number).alias("canonical_id"))
    by_source = s.select(F.lit("MACHINERY").alias("source"), "source_id", F.concat(F.lit("s-"), number).alias("canonical_id"))
    by_id = table(spark, sf_dir, "nation").where("n_regionkey != 3").select(F.col("n_nationkey").alias("source_id"), F.concat(F.lit("n-"), "n_name").alias("canonical_id"))
    return R.resolve(rows, explicit, by_source, by_id)


@query("""SELECT k AS name_key, min(id) AS id FROM (SELECT o_orderkey AS id, 'club ' || CAST(o_custkey AS VARCHAR) AS k FROM orders) GROUP BY k HAVING count(DISTINCT id) = 1""")
def unique_name_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stand for one id only."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("AFC Club "), F.col("o_custkey").cast("string")).alias("label"))
    return R.unique_names(rows, N.name_key(F.col("label")))


@query("""SELECT entity_type, canonical_id, count(DISTINCT source) AS sources FROM (SELECT 'nation' AS entity_type, CAST(c_nationkey AS VARCHAR) AS canonical_id, 'customer' AS source FROM customer UNION ALL SELECT 'nation', CAST(s_nationkey AS VARCHAR), 'supplier' FROM supplier
  UNION ALL SELECT 'segment', c_mktsegment, 'customer' FROM customer) GROUP BY ALL HAVING count(DISTINCT source) >= 2""")
def cross_source_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that two sources share."""
    c = table(spark, sf_dir, "customer")
    one = c.select(F.lit("nation").alias("entity_type"), F.col("c_nationkey").cast("string").alias("canonical_id"), F.lit("customer").alias("source"))
    two = table(spark, sf_dir, "supplier").select(F.lit("nation").alias("entity_type"), F.col("s_nationkey").cast("string").alias("canonical_id"), F.lit("supplier").alias("source"))
    three = c.select(F.lit("segment").alias("entity_type"), F.col("c_mktsegment").alias("canonical_id"), F.lit("customer").alias("source"))
    return R.confirmed_by_several(one.unionByName(two).unionByName(three))


@query("""WITH log AS (SELECT o_custkey AS sid, o_orderkey % 3 AS cid, CASE o_orderkey % 4 WHEN 0 THEN 'proposed' WHEN 1 THEN 'rejected' ELSE 'confirmed' END AS status, o_orderdate AS d FROM orders),
l AS (SELECT sid, cid, arg_max(status, struct_pack(a := d, b := status)) AS status FROM log GROUP BY sid, cid), w AS (SELECT *, count(*) FILTER (WHERE status = 'confirmed') OVER (PARTITION BY sid) AS n FROM l)
SELECT sid AS source_fixture_id, cid AS canonical_fixture_id, CASE WHEN status = 'confirmed' AND n > 1 THEN 'ambiguous' ELSE status END AS status FROM w""")
def mapping_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each mapping, at most one confirmed."""
    k = F.col("o_orderkey")
    log = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_fixture_id"), (k % 3).alias("canonical_fixture_id"), F.when(k % 4 == 0, "proposed").when(k % 4 == 1, "rejected").otherwise("confirmed").alias("status"), F.col("o_orderdate").alias("decided_at"))
    return R.latest_mapping(log)


@query("""SELECT l_orderkey, l_linenumber, count(*) AS sources, array_to_string(list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))), ',') AS evidence FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def provider_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a provider key, its evidence united."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return rows.agg(F.count("*").alias("sources"), F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ",").alias("evidence"))


@query(f"""WITH {MATCHES}, m AS (SELECT fixture_id, kickoff_at, kickoff_at + to_hours(CAST(CASE WHEN fixture_id % 5 = 0 THEN 1 WHEN fixture_id % 7 = 0 THEN 3 ELSE 0 END AS INTEGER)) AS theirs, (kickoff_at AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' AS wall FROM matches)
SELECT CASE WHEN theirs = kickoff_at THEN 'agree' WHEN theirs = wall THEN 'timezone_normalization_artifact' ELSE 'schedule_revision' END AS classification, count(*) AS n FROM m GROUP BY 1""")
def timezone_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kick-off differences that are only a zone left unconverted."""
    k = F.col("fixture_id")
    m = matches(spark, sf_dir).withColumn("theirs", (F.col("kickoff_at").cast("timestamp") + F.make_dt_interval(hours=F.when(k % 5 == 0, 1).when(k % 7 == 0, 3).otherwise(0))).cast("timestamp_ntz"))
    wall = F.from_utc_timestamp(F.col("kickoff_at").cast("timestamp"), "Europe/London").cast("timestamp_ntz")
    kind = F.when(F.col("theirs") == F.col("kickoff_at"), "agree").when(F.col("theirs") == wall, "timezone_normalization_artifact").otherwise("schedule_revision")
    return m.groupBy(kind.alias("classification")).agg(F.count("*").alias("n"))


@query(f"""WITH {LEDGER} SELECT source, capability, state, count(*) AS n_rows, count(DISTINCT fixture_id) AS fixtures FROM ledger GROUP BY ALL""")
def coverage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fixtures per source, capability and state."""
    return R.coverage(ledger(spark, sf_dir), "source", "capability", "state")


@query("""WITH o AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 <> 0), i AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer)
SELECT i.c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'inserted' WHEN o.c_acctbal = i.c_acctbal AND o.c_name = i.c_name THEN 'replayed' ELSE 'conflict' END AS write_state FROM i LEFT JOIN o ON i.c_custkey = o.c_custkey""")
def append_only_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: new rows, replays and conflicts of an append-only table."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    incoming = c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return K.append_only(c.where("c_custkey % 3 != 0"), incoming, "c_custkey", ["c_name", "c_acctbal"])


@query("""SELECT row_id, fixture_id, status, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY fixture_id ORDER BY updated_at DESC NULLS LAST, row_id % 2 DESC, row_id DESC) AS n FROM live_fixture) WHERE n = 1""")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: an upsert that never goes back in time."""
    rows = table(spark, sf_dir, "live_fixture").select("fixture_id", "row_id", "status", "updated_at", F.format_string("%012d", "row_id").alias("tie"))
    both = rows.where("row_id % 2 = 0").withColumn("_n", F.lit(0)).unionByName(rows.where("row_id % 2 = 1").withColumn("_n", F.lit(1)))
    from chronopitch.operators.ordered import latest_by

    return latest_by(both, ["fixture_id"], F.col("updated_at"), F.col("_n"), F.col("tie")).select("row_id", "fixture_id", "status", "updated_at")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0), i AS (SELECT o_orderkey, 'NEW' AS o_orderpriority, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice + 1 END AS o_totalprice FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(o.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority, coalesce(i.o_totalprice, o.o_totalprice) AS o_totalprice FROM o FULL JOIN i ON o.o_orderkey = i.o_orderkey""")
def coalesce_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: an upsert in which a missing score never erases a known one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    incoming = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("NEW").alias("o_orderpriority"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") + 1).alias("o_totalprice"))
    return K.coalesce_upsert(o.where("o_orderkey % 4 != 0"), incoming, "o_orderkey", ["o_totalprice"])


@query("""WITH r AS (SELECT * FROM (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('FURNITURE', 3)) AS t(source, rnk)), c AS (SELECT c_custkey, c_mktsegment AS source, c_acctbal FROM customer),
i AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS source, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0),
j AS (SELECT c.c_custkey, c.source AS cs, i.source AS isrc, c.c_acctbal AS cb, i.c_acctbal AS ib, coalesce(rc.rnk, 4) AS rc, ri.rnk AS ri FROM c LEFT JOIN i ON c.c_custkey = i.c_custkey LEFT JOIN r rc ON rc.source = c.source LEFT JOIN r ri ON ri.source = i.source),
t AS (SELECT *, isrc IS NOT NULL AND (cs = isrc OR (ri IS NOT NULL AND ri <= rc)) AS take FROM j)
SELECT c_custkey, CASE WHEN take THEN isrc ELSE cs END AS source, CASE WHEN take THEN ib ELSE cb END AS c_acctbal, take AS updated FROM t""")
def authority_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that only a source of no lower authority may make."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("source"), "c_acctbal")
    k = F.col("c_custkey")
    incoming = c.where((k % 2 == 0) | (k % 3 == 0)).select("c_custkey", F.get(F.array(*(F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))), F.pmod(k, F.lit(4)).cast("int")).alias("source"), (F.col("c_acctbal") * 2).alias("c_acctbal"))
    return K.authority_update(c, incoming, "c_custkey", ["AUTOMOBILE", "BUILDING", "FURNITURE"])


_CHAIN = f"{LEDGER}, ch AS (SELECT entry_id, fixture_id, CASE WHEN k % 5 = 0 THEN lag(entry_id) OVER (PARTITION BY fixture_id ORDER BY knowledge_at, entry_id) END AS supersedes FROM ledger)"


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    # A fixture's log is bounded by its observations; the chain itself is stored, not computed, in a real table.
    w = Window.partitionBy("fixture_id").orderBy("knowledge_at", "entry_id")
    return ledger(spark, sf_dir).select("entry_id", "fixture_id", F.when(F.col("k") % 5 == 0, F.lag("entry_id").over(w)).alias("supersedes"))


@query(f"""WITH {_CHAIN} SELECT entry_id, fixture_id FROM ch WHERE entry_id NOT IN (SELECT supersedes FROM ch WHERE supersedes IS NOT NULL)""")
def supersession_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that nothing supersedes."""
    return K.current_of_chain(_chain(spark, sf_dir), "entry_id", "supersedes").select("entry_id", "fixture_id")


@query(f"""WITH {_CHAIN}, c AS (SELECT fixture_id, count(*) AS n FROM ch WHERE entry_id NOT IN (SELECT supersedes FROM ch WHERE supersedes IS NOT NULL) GROUP BY fixture_id)
SELECT fixture_id, CAST(0 AS BIGINT) AS missing_parent, CAST(0 AS BIGINT) AS forked, n AS several_current FROM c WHERE n > 1""")
def chain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures whose chain has lost a parent, forks, or has several current rows."""
    return K.chain_violations(_chain(spark, sf_dir), "entry_id", "supersedes", ["fixture_id"])


@query("""SELECT 'only_customer' AS side, count(*) AS n FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'both', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'any', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two sources share, and what only one has."""
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n"))
    one = lambda side, df: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return one("only_customer", a.subtract(b)).union(one("both", a.intersect(b))).union(one("any", a.union(b).distinct()))


@query(f"""WITH {MATCHES} SELECT (SELECT count(*) FROM matches) AS fixtures, (SELECT count(DISTINCT season) FROM matches) AS seasons, (SELECT count(*) FROM (SELECT home_team FROM matches UNION SELECT away_team FROM matches)) AS teams""")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, seasons and teams."""
    m = matches(spark, sf_dir)
    teams = m.select(F.explode(F.array("home_team", "away_team")).alias("t")).agg(F.count_distinct("t").alias("teams"))
    return m.agg(F.count("*").alias("fixtures"), F.count_distinct("season").alias("seasons")).crossJoin(teams)  # a single row each
