"""Reports on discoveries: outcomes of clusters, annotation, coverage by patient, sensitivity and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE, Config
from ..functions import sequence as S
from .insertions import best_hit, polya_label
from .intervals import first_hits, lift_over

# Outcomes of a cluster.
TOO_FEW, RESCUED, EXCLUDED, IMPRECISE, SHORT_CLIP, SHORT_ALIGNED, REPEAT, PASSED = "too_few", "rescued_polya", "excluded", "too_few_precise", "short_clip", "short_aligned", "short_repeat", "passed"


def cluster_outcome(n: Column, barred: Column, n_best: Column, rescued: Column, clip_size: Column, aligned_size: Column, repeat: Column, config: Config = MOUSE) -> Column:
    """Why a cluster of n reads stops or passes. Reads at one place: n_best, null if none is long enough."""
    return (
        F.when(rescued, RESCUED)
        .when(n == 1, TOO_FEW)
        .when(barred, EXCLUDED)
        .when(F.coalesce(n_best, F.lit(0)) < config.min_evidence_reads, IMPRECISE)
        .when(clip_size <= config.min_clip, SHORT_CLIP)
        .when(aligned_size <= config.min_aligned, SHORT_ALIGNED)
        .when(repeat, REPEAT)
        .otherwise(PASSED)
    )


def outcome_counts(clusters: DataFrame, keys: list[str], outcome: str = "outcome") -> DataFrame:
    """keys, outcome, n_clusters; one aggregation with map-side combine."""
    return clusters.groupBy(*keys, outcome).agg(F.count("*").alias("n_clusters"))


def primary_mapping(flag: Column, mapq: Column, least: int = 40) -> Column:
    """A mapping that annotates: mapped well, primary and passed."""
    return (mapq >= least) & ~S.has_flag(flag, S.QCFAIL) & ~S.has_flag(flag, S.SECONDARY) & ~S.has_flag(flag, S.SUPPLEMENTARY) & ~S.has_flag(flag, S.UNMAPPED)


def annotate(insertions: DataFrame, parts: DataFrame, hits: DataFrame, mappings: DataFrame, chain: DataFrame | None = None, left_needs_right: bool = True) -> DataFrame:
    """insertion, and for each side (left, right) its sequence, best repeat family, mapping and place.

    insertions: insertion. parts: insertion, side ('L' or 'R'), seq. hits: insertion, side, model, score, line_no.
    mappings: insertion, side, flag, mapq, contig, start, end, is_forward, line_no; of several the last counts. A clip
    without a hit that is a tail is named polyA. The place is the end of the mapping next to the insertion, lifted by
    chain (blocks with score and chain) where given, to the first hit; a place that cannot be lifted is null. left_needs_right keeps a known slip: a left mapping is
    told only if there is a right one. All joins are by insertion and side.
    """
    keys = ["insertion", "side"]
    forward = F.col("is_forward")
    last = mappings.filter(primary_mapping(F.col("flag"), F.col("mapq"))).groupBy(*keys).agg(F.max_by(F.struct("contig", "start", "end", "is_forward"), "line_no").alias("m")).select(*keys, "m.*")
    strand = F.when(forward, "+").otherwise("-")
    at = last.withColumn("align", F.concat("contig", F.lit(":"), "start", F.lit("-"), "end", strand)).withColumn("pos", F.when((F.col("side") == "R") != forward, F.col("start")).otherwise(F.col("end")))
    if chain is None:
        placed = at.withColumn("place", F.concat("contig", F.lit(":"), "pos", strand))
    else:
        first = first_hits(lift_over(at.select(*keys, "contig", "pos"), chain), keys)
        turned = F.when(F.col("lifted_strand") == "-", ~forward).otherwise(forward)
        placed = at.join(first, keys, "left").withColumn("place", F.concat("lifted_contig", F.lit(":"), "lifted_pos", F.when(turned, "+").otherwise("-")))
    sides = parts.join(best_hit(hits, keys, "model", "score", "line_no").select(*keys, "model"), keys, "left").join(placed.select(*keys, "align", "place"), keys, "left")
    sides = sides.withColumn("model", polya_label(F.col("model"), F.col("side"), F.col("seq")))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    names = (("L", "left"), ("R", "right"))
    wide = sides.groupBy("insertion").agg(*(of(s, c).alias(f"{name}_{c}") for c in ("seq", "model", "align", "place") for s, name in names))
    if left_needs_right:
        wide = wide.withColumn("left_align", F.when(F.col("right_align").isNotNull(), F.col("left_align")))
    return insertions.select("insertion").join(wide, "insertion", "left")


def coverage_by_patient(counts: DataFrame, listed: DataFrame, files: DataFrame) -> DataFrame:
    """name, patient, n_found, n_files of the insertions listed (name): how many of a patient's files have each.

    counts: name, patient, n_found; files: patient and one row for each of its files.
    """
    totals = files.groupBy("patient").agg(F.count("*").alias("n_files"))
    return counts.join(listed.select("name").distinct(), "name", "left_semi").join(totals, "patient", "left").select("name", "patient", "n_found", F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"))


def patient_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """paths -> patient (the first seven characters), file (without its ending of eight): names in folders whose name has no 'old' in it."""
    steps = F.split(path, "/")
    file = F.element_at(steps, -1)
    rows = paths.filter((F.size(steps) > 1) & ~F.element_at(steps, -2).contains("old") & (F.length(file) > 6))
    return rows.select(F.substring(file, 1, 7).alias("patient"), F.substr(file, F.lit(1), F.greatest(F.length(file) - 8, F.lit(0))).alias("file"))


def sensitivity(tiers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_found, n_missed, found_percent, polya_percent (of what is found, by the left place alone) of truths with their tier."""
    found = F.col("tier").isNotNull()
    sums = tiers.groupBy(*keys).agg(F.count_if(found).alias("n_found"), F.count_if(~found).alias("n_missed"), F.count_if(F.col("tier") == "right_polya").alias("__polya"))
    share = lambda part, whole: F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
    return sums.select(*keys, "n_found", "n_missed", share(F.col("n_found"), F.col("n_found") + F.col("n_missed")).alias("found_percent"), share(F.col("__polya"), F.col("n_found")).alias("polya_percent"))


def compare_discoveries(a: DataFrame, b: DataFrame, name: str, most: int = 10) -> DataFrame:
    """One row on two tables of (name, file): distinct names of each and of both; of either, names of one file, shared and new ones of one file, new ones of 2 to most - 1 files."""
    size = lambda df, into: df.groupBy(name).agg(F.count("*").alias(into))
    both = size(a, "a").join(size(b, "b"), name, "full")
    shared = F.col("a").isNotNull() & F.col("b").isNotNull()
    counts = [F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count_if(shared).alias("n_both")]
    for x in "ab":
        n = F.col(x)
        new = n.isNotNull() & ~shared
        counts += [F.count_if(n == 1).alias(f"single_{x}"), F.count_if(shared & (n == 1)).alias(f"shared_single_{x}"), F.count_if(new & (n == 1)).alias(f"new_single_{x}"), F.count_if(new & (n > 1) & (n < most)).alias(f"new_few_{x}")]
    return both.agg(*counts)


def most_memory(stats: DataFrame, mem: str = "mem") -> DataFrame:
    """One row: the greatest memory as text, in the order of text, as it is written; null if there is none."""
    return stats.agg(F.max(mem).alias(mem))
