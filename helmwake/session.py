"""Session defaults, table access and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "helmwake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling, Arrow).

    On a cluster the master and the memory sizes come from spark-submit; only
    settings that change results or plans are set here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share; taken from spark.checkpoint.dir.

    Only where the setting is missing (tests, local runs) a temporary folder is
    made and set, as a local session has no other machine to share it with.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="helmwake-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def bench_cores(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
