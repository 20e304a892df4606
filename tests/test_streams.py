import os

from pyspark.sql import functions as F

from chronopitch.operators import late, shadow
from chronopitch.session import table
from chronopitch.streaming import streams


def landing(spark, df, path, parts=3):
    df.repartition(parts).write.parquet(str(path))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_late_counts_equal_the_batch(spark, data, tmp_path):
    """Files land in order of knowledge, so events of a day come late over many files; the stream ends where the batch does."""
    rows = table(spark, data, "ledger_entry").select("entry_id", "source", "capability", "source_observed_at", "available_at", "knowledge_at").where("knowledge_at IS NOT NULL")
    rows = rows.orderBy("knowledge_at", "entry_id").toPandas()
    path = tmp_path / "in"
    schema = table(spark, data, "ledger_entry").select(*rows.columns).schema
    size = -(-len(rows) // 6)
    path.mkdir()
    kept, dropped = {}, {}
    stream = streams.late_counts(spark.readStream.schema(schema).parquet(str(path)))

    def keep(batch, _):
        for r in batch.collect():
            key = (r["source"], r["capability"], r["day"])
            if r["first_count"] or r["corrections"]:
                kept[key] = (r["first_count"], r["final_count"], r["corrections"])
            dropped.setdefault(key, []).append(r["dropped"])

    for n in range(6):
        spark.createDataFrame(rows.iloc[n * size : (n + 1) * size], schema).coalesce(1).write.mode("append").parquet(str(path))
        streams.drain(stream, str(tmp_path / "cp"), keep)
    batch = late.counts(late.replayed(spark.createDataFrame(rows, schema), ["source", "capability"]), ["source", "capability"], ["string", "string"]).collect()
    expected = {(r["source"], r["capability"], r["period_start"]): (r["first_count"], r["final_count"], r["corrections"]) for r in batch if r["final_count"]}
    assert kept == expected and any(c for _, _, c in kept.values())
    assert sum(map(max, dropped.values())) <= sum(r["dropped"] for r in batch) <= sum(map(sum, dropped.values()))


def test_live_projection_equals_the_batch(spark, data, tmp_path):
    rows = table(spark, data, "live_fixture").withColumn("update_id", F.col("row_id")).select("fixture_id", "update_id", "updated_at", "status", "home_goals", "away_goals", "knowledge_at").where("updated_at IS NOT NULL")
    kept = {}
    stream = streams.live_projection(landing(spark, rows, tmp_path / "in", 1))
    streams.drain(stream, str(tmp_path / "cp"), lambda b, n: kept.update({r["fixture_id"]: (r["status"], r["home_goals"], r["away_goals"], r["updates"]) for r in b.collect()}))
    batch = {r["fixture_id"]: (r["status"], r["home_goals"], r["away_goals"], r["updates"]) for r in shadow.projection(rows, "fixture_id").collect()}
    assert kept == batch


def test_due_and_missed_and_health(spark, tmp_path):
    t = spark.sql("SELECT 't' || id task_id, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id) scheduled_for FROM range(6)")
    o = spark.sql("SELECT 't' || id o_task_id, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id, if(id = 2, 30, 5)) recorded_at FROM range(6) WHERE id IN (0, 1, 2, 5)")
    got = []
    stream = streams.due_and_missed(landing(spark, t, tmp_path / "t", 1), landing(spark, o, tmp_path / "o", 1))
    streams.drain(stream, str(tmp_path / "cp"), lambda b, n: got.extend((r["task_id"], r["state"]) for r in b.collect()), "append")
    assert {("t0", "success"), ("t1", "success"), ("t5", "success"), ("t2", "missed_observation"), ("t3", "missed_observation")} <= set(got)
    s = spark.sql("SELECT 's' source, 'c' capability, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 20 * id) attempted_at, id % 2 = 0 success FROM range(6)")
    seen = {}
    streams.drain(streams.health(landing(spark, s, tmp_path / "s", 2)), str(tmp_path / "cp2"), lambda b, n: seen.update({r["window"]["start"]: (r["attempts"], r["failures"]) for r in b.collect()}))
    assert sorted(seen.values()) == [(3, 1), (3, 2)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    write = streams.idempotent_append(str(tmp_path / "out"), "k")
    write(spark.createDataFrame([("a",), ("b",)], "k string"), 0)
    write(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    write(spark.createDataFrame([("b",), ("c",)], "k string"), 1)
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
    assert os.path.isdir(tmp_path / "out" / "batch=1")
