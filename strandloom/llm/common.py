"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package even where the driver alone has it on its path."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH", ""), _ROOT) if x)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: spark.checkpoint.dir. A local session without one (tests) gets a temporary folder; a cluster must name it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandloom-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._strandloom_path = path
    return out


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """stored(), in buckets of key: later joins on key do not move the table again."""
    spark, n = df.sparkSession, shuffle_partitions(df.sparkSession)
    own = f"{name}-{uuid.uuid4().hex[:12]}"
    path, view = f"{shared_dir(spark)}/{own}", own.replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).format("parquet").saveAsTable(view)
    out = spark.table(view)
    out._strandloom_path, out._strandloom_table = path, view
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by stored() or stored_by() that no later plan reads."""
    for df in tables:
        if view := getattr(df, "_strandloom_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {view}")
        if path := getattr(df, "_strandloom_path", None):
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def with_places(df: DataFrame, into: str) -> DataFrame:
    """df + into: a long that is another for each row, and the same in every scan: the file's number and the row's in the file.

    df must be a plain scan of Parquet files; another table is written first. Files are numbered in the order of their
    names, a list that the driver holds for any scan; so the number does not depend on how a scan is split into tasks.
    """
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    except AnalysisException:
        df = stored(df, "placed")
        placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    files = placed.select("__file").distinct().withColumn("__number", F.row_number().over(Window.orderBy("__file")))
    return placed.join(F.broadcast(files), "__file").withColumn(into, F.shiftleft(F.col("__number").cast("long"), 40) + F.col("__index")).drop("__file", "__index", "__number")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, one after another, and the n + 1 offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about limit bytes; a longer text comes alone. No row is split or lost."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        texts = batch.column(column)
        lengths = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def list_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose lists have about limit elements in all; a longer list comes alone. No row is split or lost."""
    for batch in batches:
        ends = np.cumsum(pa.compute.list_value_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
