"""Landed files: season results as CSV, evidence as binary files, and a data source for folders of JSON payloads."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chronopitch.functions import normalize as N
from chronopitch.operators.reconcile import keep_best

RESULTS = "Date string, Time string, HomeTeam string, AwayTeam string, FTHG string, FTAG string, FTR string, B365H string, B365D string, B365A string, AvgH string, AvgD string, AvgA string"
_NEEDED = ("Date", "HomeTeam", "AwayTeam")


def season_results(spark: SparkSession, path: str, zone: str = "Europe/London") -> tuple[DataFrame, DataFrame]:
    """(fixtures, quarantined) of all season files under a path: latin-1, columns by header, season from the file's name.

    A row without a readable date or a team is quarantined, as is one whose wall clock names no or two instants; a
    match that a file holds twice goes by the completed row, else the last. Headers that lack a needed column fail.
    """
    raw = spark.read.csv(path, header=True, encoding="ISO-8859-1")
    lost = [c for c in _NEEDED if c not in raw.columns]
    if lost:
        raise ValueError(f"schema drift: no column {', '.join(lost)}")
    names = [c.split()[0] for c in RESULTS.split(", ")]
    rows = raw.select(*(F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in names), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("row_no"))
    code = F.regexp_extract("file", r"(\d{4})", 1)
    day = N.match_date(F.trim("Date"))
    timed = F.trim("Time").rlike(r"^\d{1,2}:\d{2}$")
    local = F.try_to_timestamp(F.concat(day.cast("string"), F.lit(" "), F.when(timed, F.lpad(F.trim("Time"), 5, "0")).otherwise("00:00")))
    utc, gap, fold = N.wall_clock(local.cast("timestamp_ntz"), zone)
    home, away = N.safe_int(F.col("FTHG")), N.safe_int(F.col("FTAG"))
    rows = rows.withColumns({"season": N.season_from_code(code), "kickoff_at": utc, "home_goals": home, "away_goals": away, "gap": gap, "fold": fold})
    reason = F.when(F.col("HomeTeam").isNull() | F.col("AwayTeam").isNull(), "no_team").when(F.col("gap"), "nonexistent_time").when(F.col("fold"), "ambiguous_time").when(F.col("kickoff_at").isNull(), "unreadable_date")
    rows = rows.withColumn("reason", reason)
    team = lambda c: F.concat(F.lit("team:epl:"), N.slug(F.col(c)))
    fine = rows.where("reason IS NULL").withColumn("fixture_id", F.concat_ws(":", F.lit("fixture:epl"), "season", N.slug(F.col("HomeTeam")), N.slug(F.col("AwayTeam")))).withColumns({"home_team": team("HomeTeam"), "away_team": team("AwayTeam")})
    scored = F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    kept = ["fixture_id", "season", "kickoff_at", "home_team", "away_team", "home_goals", "away_goals", "row_no"]
    return keep_best(fine.select(*kept), ["fixture_id"], scored, F.col("row_no")).drop("row_no"), rows.where("reason IS NOT NULL").select("file", "Date", "Time", "HomeTeam", "AwayTeam", "reason")


def evidence(spark: SparkSession, path: str) -> DataFrame:
    """Raw payload files, each once under its content hash."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.sha2("content", 256).alias("content_hash"), F.col("path").alias("object_path"), F.col("modificationTime").alias("received_at"), "length", F.col("content").alias("payload"))


class LandedPayloads(DataSource):
    """spark.read.format("landed_payloads").load(folder): a row per JSON file, with its source and capability from the
    folders it lies in (source/capability/file.json). Register it with spark.dataSource.register(LandedPayloads)."""

    @classmethod
    def name(cls) -> str:
        return "landed_payloads"

    def schema(self) -> str:
        return "evidence_id string, source string, capability string, object_path string, payload string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001, ARG002
        return _Landed(self.options["path"])


class _Landed(DataSourceReader):
    #: Files of one partition.
    EACH = 512

    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self):
        files = sorted(os.path.join(d, f) for d, _, names in os.walk(self.path) for f in names if f.endswith(".json"))
        return [InputPartition(files[i : i + self.EACH]) for i in range(0, len(files), self.EACH)]

    def read(self, partition):
        for file in partition.value:
            with open(file, "rb") as f:
                payload = f.read()
            parts = os.path.relpath(file, self.path).split(os.sep)
            source, capability = (parts + ["", ""])[:2] if len(parts) > 2 else ("", "")
            yield "ev-" + hashlib.sha256(payload).hexdigest()[:20], source, capability, file, payload.decode("utf-8", "replace")
