"""Operators on discovered insertions: mates, merging, k-mer filters, best hits, overlaps and truth sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE, Config
from ..functions import sequence as S

# Kinds of insertions.
FULL, RIGHT_POLYA, LEFT_POLYA = "full", "right_polya", "left_polya"


def resolve_claims(claims: DataFrame) -> DataFrame:
    """(qname, side 'L' 'R' or 'P', ordinal, want_read1, bp) -> (qname, want_read1, bp): whose mate each name is.

    Right breakpoints come before left ones, the last by ordinal within a side; a poly-A breakpoint counts only for a
    name without others, the first one then. A name wanted as both reads is nobody's. One shuffle, no windows.
    """
    polya = F.col("side") == "P"
    rank = F.struct(F.when(F.col("side") == "R", 2).when(F.col("side") == "L", 1).otherwise(0), F.when(polya, -F.col("ordinal")).otherwise(F.col("ordinal")))
    by_name = claims.groupBy("qname").agg(
        F.max_by(F.struct("bp", "want_read1", "side"), rank).alias("__top"),
        F.min(F.when(~polya, F.col("want_read1"))).alias("__lo"),
        F.max(F.when(~polya, F.col("want_read1"))).alias("__hi"),
    )
    agreed = F.coalesce(F.col("__lo") == F.col("__hi"), F.lit(True))
    return by_name.filter(agreed).select("qname", F.coalesce("__lo", F.col("__top.want_read1")).alias("want_read1"), F.col("__top.bp").alias("bp"))


def find_mates(claims: DataFrame, reads: DataFrame, keep: list[str]) -> DataFrame:
    """Reads that are the wanted mates: bp + keep. reads: qname, is_read1 and keep. An equi-join by name."""
    wanted = resolve_claims(claims)
    return reads.join(wanted, (reads["qname"] == wanted["qname"]) & (reads["is_read1"] == wanted["want_read1"])).select("bp", *keep)


def merge_insertions(df: DataFrame, keys: list[str], seqs: list[str], order: str, config: Config = MOUSE, lists: tuple[str, ...] = ()) -> DataFrame:
    """One insertion for each key: the longest of each sequence (the first by order among equals) and all lists (array columns) joined in order.

    A key with several insertions stays only if the members agree, by match_score, in every sequence. What is gathered
    for a key is one insertion from each file that found it.
    """
    gathered = df.groupBy(*keys).agg(
        F.count("*").alias("n_merged"),
        *(F.collect_list(c).alias(f"__{c}") for c in seqs),
        *(F.max_by(c, F.struct(F.length(F.col(c)["seq"]), -F.col(order))).alias(c) for c in seqs),
        *(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("v")))), lambda x: x["v"]).alias(c) for c in lists),
    )
    agree = F.lit(True)
    for c in seqs:
        agree = agree & F.coalesce(S.match_score(F.col(f"__{c}")) >= config.match_score, F.lit(False))
    return gathered.filter((F.col("n_merged") == 1) | agree).select(*keys, "n_merged", *seqs, *(F.flatten(c).alias(c) for c in lists))


def reference_problem(kind: Column, left_ref: Column, left_alt: Column, right_ref: Column, right_alt: Column) -> Column:
    """Why an insertion cannot be genotyped by its k-mers, the first reason in order; null if it can."""
    has_right, has_left = kind != RIGHT_POLYA, kind != LEFT_POLYA
    missing = (has_right & (F.coalesce(right_ref, F.lit("")) == "")) | (has_left & (F.coalesce(left_ref, F.lit("")) == ""))
    has_n = lambda on, ref: on & F.coalesce(ref.contains("N"), F.lit(False))
    left_like, right_like = (F.coalesce(S.pair_score(r, a) > 0, F.lit(False)) for r, a in ((left_ref, left_alt), (right_ref, right_alt)))
    return (
        F.when(missing, "missing")
        .when(has_n(has_right, right_ref) | has_n(has_left, left_ref), "unknown_bases")
        .when((kind == RIGHT_POLYA) & left_like, "left_similar")
        .when((kind == LEFT_POLYA) & right_like, "right_similar")
        .when((kind == FULL) & left_like & right_like, "both_similar")
        .when((kind == FULL) & ((left_ref == S.revcomp(right_ref)) | (left_ref == right_ref)), "identical")
    )


def best_hit(hits: DataFrame, keys: list[str], model: str, score: str, line: str) -> DataFrame:
    """keys, model, score of the best hit; the first line wins a tie."""
    return hits.groupBy(*keys).agg(F.max_by(model, F.struct(score, -F.col(line))).alias(model), F.max(score).alias(score))


def polya_label(model: Column, side: Column, clip: Column) -> Column:
    """The hit's model, or polyA for a clip that starts (left) or ends (right) with six t (a)."""
    return F.coalesce(model, F.when((side == "L") & clip.startswith("tttttt"), "polyA").when((side == "R") & clip.endswith("aaaaaa"), "polyA"))


def set_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: sizes of both sets, of what they share, and of what either has alone, by one full join of distinct keys."""
    left, right = a.select(key).distinct().withColumn("__a", F.lit(1)), b.select(key).distinct().withColumn("__b", F.lit(1))
    both = left.join(right, key, "full")
    return both.agg(F.count("__a").alias("n_a"), F.count("__b").alias("n_b"), F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("n_both"), F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).unionByName(b.subtract(a))


def cap_by_file(df: DataFrame, file: str, most: int = MOUSE.max_insertions_per_file) -> DataFrame:
    """Rows of files with at most so many rows."""
    over = df.groupBy(file).agg(F.count("*").alias("__n")).filter(F.col("__n") > most).select(file)
    return df.join(over, file, "left_anti")


def truth_tier(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """truth (keys, left, right) + tier: 'exact', 'right_polya' (only the left place found), 'left_polya' or null.

    found: keys, left, right, one of them null where poly-A stands for it. Three equi-joins on distinct places.
    """
    both = found.filter("left is not null and right is not null").select(*keys, "left", "right").distinct().withColumn("__x", F.lit("exact"))
    left = found.filter("left is not null and right is null").select(*keys, "left").distinct().withColumn("__l", F.lit("right_polya"))
    right = found.filter("left is null and right is not null").select(*keys, "right").distinct().withColumn("__r", F.lit("left_polya"))
    return truth.join(both, [*keys, "left", "right"], "left").join(left, [*keys, "left"], "left").join(right, [*keys, "right"], "left").select(*truth.columns, F.coalesce("__x", "__l", "__r").alias("tier"))

