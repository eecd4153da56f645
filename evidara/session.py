"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "evidara", cpus: int | None = None, memory: str = "12g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it; a local session
    that names none gets one of its own."""
    global _own_dir
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    _own_dir = _own_dir or tempfile.mkdtemp(prefix="run-")
    return _own_dir


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the copy.

    Used where one result feeds several branches of a plan: the branches then
    read the copy instead of each repeating the work, and a lost executor costs
    a re-read, not a re-run.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
