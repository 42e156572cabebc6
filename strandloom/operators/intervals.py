"""Joins of half-open intervals and points by bins, so that no join is left with inequalities alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE
from . import axis


def _binned(df: DataFrame, start: str, end: str, width: int, into: str) -> DataFrame:
    last = F.greatest(F.col(start), F.col(end) - 1)
    return df.withColumn(into, F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(last / width))))


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], a_range: tuple[str, str], b_range: tuple[str, str], width: int = 1000) -> DataFrame:
    """Rows of a and b with equal keys and overlapping half-open ranges; column names must differ but for keys.

    Both sides are dealt into bins of width; a pair is kept in one bin only, the later of its two first bins. Rows
    multiply by their length over width, so width should be near the longer side's usual length. Empty ranges overlap
    nothing. Crowded places spread over their bins and are split by adaptive skew handling.
    """
    (a0, a1), (b0, b1) = a_range, b_range
    some = lambda df, lo, hi: df.filter(F.col(lo) < F.col(hi))
    left, right = _binned(some(a, a0, a1), a0, a1, width, "__bin"), _binned(some(b, b0, b1), b0, b1, width, "__bin")
    joined = left.join(right, [*keys, "__bin"])
    first = F.floor(F.greatest(F.col(a0), F.col(b0)) / width)
    return joined.filter((F.col(a0) < F.col(b1)) & (F.col(b0) < F.col(a1)) & (F.col("__bin") == first)).drop("__bin")


def count_overlaps(targets: DataFrame, reads: DataFrame, keys: list[str], target_range: tuple[str, str], read_range: tuple[str, str], ids: list[str], width: int = axis.WIDTH) -> DataFrame:
    """ids of all targets + n: reads whose half-open ranges overlap theirs, 0 if none; empty ranges overlap nothing.

    A sweep: the reads that overlap a target are those that begin before its end, less those that end before its
    begin. Both are running sums over the places where reads begin and end and where targets ask, so no pair is made,
    and the cost does not depend on the depth. Null keys and null places have no overlap. Targets that share ids are
    added up.
    """
    (t0, t1), (r0, r1) = target_range, read_range
    some = lambda df, lo, hi: df.filter(F.col(lo) < F.col(hi)).dropna(subset=keys)
    event = lambda at, began, ended, asked: F.struct(at.cast("long").alias("__at"), F.lit(began).alias("__began"), F.lit(ended).alias("__ended"), F.lit(asked).alias("__asked"))
    listed = lambda df, *events: df.select(*keys, F.explode(F.array(*events)).alias("__e")).select(*keys, "__e.*")
    last = F.col(t1) - 1
    events = listed(some(reads, r0, r1), event(F.col(r0), 1, 0, False), event(F.col(r1), 0, 1, False))
    asked = listed(some(targets, t0, t1), event(last, 0, 0, True), event(F.col(t0), 0, 0, True))
    places = events.unionByName(asked).groupBy(*keys, "__at").agg(*(F.sum(c).alias(c) for c in ("__began", "__ended")), F.max("__asked").alias("__asked"))
    sums = axis.running_sums(places, keys, "__at", ["__began", "__ended"], width).filter("__asked").select(*keys, "__at", "__began_to", "__ended_to")
    question = F.explode(F.array(F.struct(last.cast("long").alias("__at"), F.lit(True).alias("__end")), F.struct(F.col(t0).cast("long").alias("__at"), F.lit(False).alias("__end"))))
    answered = targets.select(*ids, *(c for c in keys if c not in ids), (F.col(t0) < F.col(t1)).alias("__some"), question.alias("__q")).select("*", "__q.*").join(sums, [*keys, "__at"], "left")
    n = F.when(F.col("__some"), F.when(F.col("__end"), F.col("__began_to")).otherwise(-F.col("__ended_to")))
    return answered.groupBy(*ids).agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"))


def without_hot_bins(df: DataFrame, contig: str, pos: str, width: int = MOUSE.bin_width, hot: int = MOUSE.bin_hot, margin: int = MOUSE.bin_margin) -> DataFrame:
    """Rows that are not within margin (exclusive) of a bin with hot or more rows; a null place stays.

    The bins next to a hot one are named by equality, at most as many as the margin spans, so the anti join needs no
    range condition but a check.
    """
    bins = df.groupBy(contig, (F.floor(F.col(pos) / width) * width).alias("__bin")).agg(F.count("*").alias("__n")).filter(F.col("__n") >= hot)
    reach = -(-margin // width)
    near = bins.select(F.col(contig).alias("__contig"), F.col("__bin").alias("__hot"), F.explode(F.array(*(F.col("__bin") + k * width for k in range(-reach, reach + 1)))).alias("__at"))
    at = F.floor(df[pos] / width) * width
    inside = (df[pos] > F.col("__hot") - margin) & (df[pos] < F.col("__hot") + width + margin)
    return df.join(near, (df[contig] == F.col("__contig")) & (at == F.col("__at")) & inside, "left_anti")


def lift_over(points: DataFrame, blocks: DataFrame, contig: str = "contig", pos: str = "pos", width: int = 100_000) -> DataFrame:
    """points x chain blocks (t_contig, t_start, t_end, q_contig, q_start, q_size, q_strand) -> points + lifted_contig, lifted_pos, lifted_strand.

    One row for each block that holds the point; points in no block give none. Where blocks have a score and a chain,
    the rows have lifted_order too, a struct of which the least is the first hit (see first_hits).
    """
    at = points.withColumn("t_contig", F.col(contig)).withColumn("__p0", F.col(pos)).withColumn("__p1", F.col(pos) + 1)
    hits = overlap_join(at, blocks, ["t_contig"], ("__p0", "__p1"), ("t_start", "t_end"), width)
    along = F.col("q_start") + F.col(pos) - F.col("t_start")
    lifted = F.when(F.col("q_strand") == "-", F.col("q_size") - 1 - along).otherwise(along)
    order = [F.struct((-F.col("score")).alias("worse"), F.col("chain"), F.col("q_contig").alias("c"), lifted.alias("p")).alias("lifted_order")] if {"score", "chain"} <= set(blocks.columns) else []
    return hits.select(*points.columns, F.col("q_contig").alias("lifted_contig"), lifted.alias("lifted_pos"), F.col("q_strand").alias("lifted_strand"), *order)


def first_hits(lifted: DataFrame, ids: list[str]) -> DataFrame:
    """ids, lifted_contig, lifted_pos, lifted_strand of each point's first hit: the chain with the highest score, of equal ones the first in the file.

    lifted: lift_over's rows with lifted_order; ids name a point. One aggregation with map-side combine.
    """
    first = F.min(F.struct("lifted_order", "lifted_contig", "lifted_pos", "lifted_strand")).alias("__h")
    return lifted.groupBy(*ids).agg(first).select(*ids, "__h.lifted_contig", "__h.lifted_pos", "__h.lifted_strand")


def genome_slices(targets: DataFrame, genome: DataFrame, ids: list[str], contig: str, start: str, end: str, chunk: int, into: str = "bases") -> DataFrame:
    """ids + into: genome bases of [start, end) from a table of chunks (contig, chunk_start, seq); '' if start >= end or the contig is unknown."""
    wanted = targets.select(*ids, F.col(contig).alias("__c"), F.col(start).alias("__s"), F.col(end).alias("__e"))
    parts = overlap_join(
        wanted.withColumnRenamed("__c", "__contig"),
        genome.select(F.col("contig").alias("__contig"), F.col("chunk_start").alias("__g0"), (F.col("chunk_start") + F.length("seq")).alias("__g1"), F.col("seq").alias("__seq")),
        ["__contig"], ("__s", "__e"), ("__g0", "__g1"), chunk,
    )
    lo, hi = F.greatest("__s", "__g0"), F.least("__e", "__g1")
    piece = F.substring(F.col("__seq"), (lo - F.col("__g0") + 1).cast("int"), (hi - lo).cast("int"))
    found = parts.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct(F.col("__g0").alias("g"), piece.alias("p")))).alias("__p"))
    return targets.select(*ids).join(found, ids, "left").select(*ids, F.coalesce(F.array_join(F.transform("__p", lambda x: x["p"]), ""), F.lit("")).alias(into))
