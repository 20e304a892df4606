"""Session settings, table access and lineage cuts shared by every plan."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings a session of this library expects; a cluster's own values for sizes win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("chronopitch")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; columns are pruned and filters pushed by the plan that uses it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder and starts a new lineage from there.

    The folder is the session's spark.checkpoint.dir; only where that is unset (tests, one machine) a
    temporary folder is made. Lost executors do not lose the rows, unlike with localCheckpoint.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir", "")
        if not shared:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="chronopitch-")
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def width(spark: SparkSession, factor: int = 1) -> int:
    """Partitions for work that this library spreads itself: follows the session, which follows the data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, 1) * factor


def cells(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or typed nulls where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def sf_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
