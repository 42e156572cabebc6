"""Contiguous shards of nearly equal byte size.

Rows are put in order by key, each partition of that order gives its byte total, the running sum of the totals
gives each partition its offset, and a running sum inside the partition gives each row its place among all bytes.
The byte axis is cut at equal targets; a row belongs to the shard that holds its middle byte, so shards are
contiguous in the order and differ by one row's size at most. Only ids, sizes and checksums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored


def shard_by_bytes(df: DataFrame, n_shards: int, order_col: str, size_col: str, *payload: str) -> DataFrame:
    """Give every row a shard (0 to n_shards - 1), contiguous in order_col, and its slot in the shard (gapless from 0).

    Returns order_col, size_col, payload, shard int, slot long. Null keys come first; equal keys are put in order by
    size and payload, and rows alike in all of them are interchangeable. An empty table gives no rows. If all sizes
    are 0, all rows go to shard 0.
    """
    keys = [order_col, size_col, *payload]
    rows = df.select(*keys)
    n = shuffle_partitions(df.sparkSession)
    placed = stored(rows.repartitionByRange(n, *keys).withColumn("__part", F.spark_partition_id()), "shard-rows")
    whole = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ever = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row for each partition of the order.
    totals = placed.groupBy("__part").agg(F.sum(size_col).alias("__bytes"), F.count("*").alias("__rows"))
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("__bytes").over(whole), F.lit(0)).alias("__before"),
        F.coalesce(F.sum("__rows").over(whole), F.lit(0)).alias("__first"),
        F.sum("__bytes").over(ever).alias("__all"),
    )
    local = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("__before") + F.sum(size_col).over(local) - F.col(size_col)
    # Integer arithmetic: twice the middle byte against twice the total.
    middle = F.expr(f"(2 * __start + `{size_col}`) * {n_shards} div (2 * greatest(__all, 1))")
    put = (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn("__start", start)
        .withColumn("__at", F.col("__first") + F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1)
        .withColumn("shard", F.least(F.lit(n_shards - 1), middle).cast("int"))
    )
    put = stored(put.select(*keys, "shard", "__at"), "shard-places")
    firsts = put.groupBy("shard").agg(F.min("__at").alias("__from"))  # n_shards rows at most
    return put.join(F.broadcast(firsts), "shard").select(*keys, "shard", (F.col("__at") - F.col("__from")).cast("long").alias("slot"))


def op3(spark, sf_dir) -> DataFrame:
    """Eight byte-balanced shards of documents. A null text counts 0 bytes (size 1) and has a null text_crc32."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    out = shard_by_bytes(docs, 8, "doc_id", "size", "text_crc32")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
