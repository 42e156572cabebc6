"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a word budget. Whole epochs of it are taken first; what is left of the budget goes to the documents
with the smallest exponential keys -ln(u) / weight, u hashed from the document's id and weight from its quality
label. The budget is met by running sums of sizes in key order, made of (source, key bucket) totals and running sums
inside a bucket, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
QUALITY_WEIGHTS = {1: 2.0, 0: 1.0}
UNLABELLED = 1.5
SEED = "mix-1"


def budgets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target): share of all sizes dealt by weight, no target above most times its source.

    Weights go round the sources in code-point order, null last. A source whose part of the budget exceeds its bound is
    filled to it, and the excess is dealt again by weight: min(bound, weight * level) with one common level, found by
    running sums over the sources by bound / weight. It works on one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).alias("w"))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ever = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = (F.lit(share) * F.sum("source_size").over(ever) - capped) / F.sum("w").over(onward)
    ranked = ranked.withColumn("level", level)
    # The first source, by ratio, that stays below its bound has the level of all that follow.
    open_level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct(F.col("cap") / F.col("w"), "level"))).over(ever)["level"]
    return ranked.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("w") * open_level, F.col("cap"))).alias("target"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the id alone: 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def mix(docs: DataFrame, labels: DataFrame, n_buckets: int = 1024) -> DataFrame:
    """(doc_id, source, size) and (doc_id, quality) -> docs' columns + source_size, target, copies int (0, 1 or 2).

    A document takes part copies times. Within a source copies differ by one at most, and the sum of size * copies is
    within half a document's size of the target. Ties of the key go by doc_id, then size. Repeated rows are separate
    documents with the same key. A source without words gets target 0. Labels that repeat count once, the largest
    quality; a missing or unknown quality weighs between good and bad. n_buckets changes the layout, not the result.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    plan = budgets(sizes).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = plan.select(F.col("source").alias("__source"), "source_size", "target", "epochs", "left")
    quality = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("quality"))
    weight = F.lit(UNLABELLED)
    for q, w in QUALITY_WEIGHTS.items():
        weight = F.when(F.col("quality") == q, F.lit(w)).otherwise(weight)
    keyed = (
        docs.join(quality, F.col("doc_id") == F.col("__id"), "left")
        .withColumn("__key", -F.log(uniform(F.col("doc_id"))) / weight)
        .withColumn("__bucket", F.floor((1 - F.exp(-F.col("__key"))) * n_buckets))
        .drop("__id", "quality")
    )
    totals = keyed.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum"))
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    local = Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The plan travels with the few rows of the offsets, so no shuffle of the documents goes by source alone.
    offsets = offsets.join(plan, F.col("__s").eqNullSafe(F.col("__source")))
    placed = keyed.withColumn("__run", F.sum("size").over(local)).join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    chosen = F.col("__before") + F.col("__run") - F.col("size") / 2 <= F.col("left")
    copies = (F.col("epochs") + F.when((F.col("left") > 0) & chosen, 1).otherwise(0)).cast("int")
    return placed.select(*docs.columns, F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"))


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def op5(spark, sf_dir) -> DataFrame:
    """The mix of documents; a null text has size 0 and a null source is a source of its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "source", words_in().alias("size"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = mix(docs, labels)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


OP5_SQL = """
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / w AS ratio FROM s
), l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), p AS (
  SELECT source, source_size, least(cap, coalesce(w * (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio), cap)) AS target FROM l
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM p
), quality AS (
  SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id
), k AS (
  SELECT d.*, -ln((('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
         / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 1.0 ELSE 1.5 END AS key
  FROM d LEFT JOIN quality USING (doc_id)
), run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0 AS mid FROM k
), c AS (
  SELECT run.doc_id, run.size, q.source_size::BIGINT AS source_size, q.target, run.source,
         (q.epochs + CASE WHEN q.target - q.epochs * q.source_size > 0 AND mid <= q.target - q.epochs * q.source_size THEN 1 ELSE 0 END)::INT AS copies
  FROM run JOIN q ON run.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, source, copies FROM c
"""
