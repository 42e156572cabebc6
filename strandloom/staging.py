"""What the batch steps need of a session: intermediate tables in the folder that all executors share, and this package in Python workers."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[1])


def importable(spark: SparkSession | None) -> None:
    """Let Python workers import this package even where the driver alone has it on its path."""
    if spark is not None:
        env = spark.sparkContext.environment
        if _ROOT not in env.get("PYTHONPATH", "").split(":"):
            env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH", ""), _ROOT) if x)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table below spark.checkpoint.dir and read it back: later plans stay small, and a lost executor costs no more than a reread.

    A local session without that setting (tests) gets a temporary folder; a cluster must name one.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandloom-"))
    path = f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
