"""From aligned reads to merged breakpoints: clips, gap clusters, cluster gates, shifted votes and their consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MOUSE, Config
from ..functions import sequence as S
from ..staging import staged
from . import ordered, reports
from .consensus import weighted_consensus

CLUSTER = ["sample", "contig", "side", "cluster"]


def clipped_reads(reads: DataFrame, config: Config = MOUSE) -> DataFrame:
    """Reads with one longer soft clip, as breakpoints: side, bp, clip and unclipped (quality sequences), exclude, forward, is_read1.

    reads: sample, ordinal, qname, flag, contig, pos, end, mapq, cigar, seq, qual, sa. Secondary, failed, duplicate and
    badly mapped reads, reads without alignment operations, unusable contigs and adapter clips are left out.
    """
    flag = F.col("flag")
    good = (F.col("mapq") >= config.min_mapq) & ~S.has_flag(flag, S.SECONDARY) & ~S.has_flag(flag, S.QCFAIL) & ~S.has_flag(flag, S.DUPLICATE)
    rows = reads.filter(good & S.usable_contig(F.col("contig"), config)).withColumn("__c", S.clip_side(F.col("cigar"))).filter("__c.side is not null and seq is not null and qual is not null")
    q, left = S.quality_seq(F.upper("seq"), F.col("qual")), F.col("__c.side") == "L"
    size, other = F.when(left, F.col("__c.left")).otherwise(F.col("__c.right")), F.when(left, F.col("__c.right")).otherwise(F.col("__c.left"))
    n = F.length("seq")
    rows = rows.select(
        "sample", "ordinal", "qname", "contig", F.col("__c.side").alias("side"), F.when(left, F.col("pos")).otherwise(F.col("end")).alias("bp"),
        F.when(left, S.q_slice(q, 0, size)).otherwise(S.q_slice(q, n - size)).alias("clip"),
        F.when(left, S.q_slice(q, size, n - other)).otherwise(S.q_slice(q, other, n - size)).alias("unclipped"),
        (S.has_flag(flag, S.SUPPLEMENTARY) & S.near_supplementary(F.col("sa"), F.col("contig"), F.col("pos"), config.same_contig_supplementary)).alias("exclude"),
        (~S.has_flag(flag, S.REVERSE)).alias("forward"), S.has_flag(flag, S.READ1).alias("is_read1"),
    )
    near = F.when(F.col("side") == "L", S.revcomp(F.col("clip.seq"))).otherwise(F.col("clip.seq"))
    return rows.filter(~S.is_adapter(F.substring(near, 1, config.min_clip), config))


def merge_clusters(clips: DataFrame, config: Config = MOUSE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(breakpoints, mates, outcomes): one breakpoint for each cluster that passes, the mates that it asks for, and what became of each cluster.

    breakpoints: CLUSTER, bp, clipped, aligned, n_reads, first (the least ordinal of the cluster). mates: CLUSTER, qname,
    want_read1. outcomes: CLUSTER, n, outcome (see reports.cluster_outcome). A cluster of one read, or without two reads at one place, passes only as a poly-A tail next to the
    breakpoint. Clips start at the breakpoint. All steps are aggregations by cluster; the clipped reads, a small part of
    all reads, and their votes are staged for them.
    """
    left = F.col("side") == "L"
    rows = ordered.gap_clusters(clips, ["sample", "contig", "side"], "bp", config.cluster_gap)
    rows = rows.withColumn("raw", F.col("clip")).withColumn("clip", S.clean_clip(F.when(left, S.q_revcomp(F.col("clip"))).otherwise(F.col("clip")), config))
    rows = rows.withColumn("has_mate", F.when(left, ~F.col("forward")).otherwise(F.col("forward")))
    rows = staged(rows, "clipped-reads")  # read by each of the aggregations below
    precise = rows.filter(F.length("clip.seq") >= config.min_clean_clip)
    best = ordered.mode(precise, CLUSTER, "bp", "best", "n_best")
    whole = rows.groupBy(*CLUSTER).agg(F.count("*").alias("n"), F.max("exclude").alias("barred"), F.min("ordinal").alias("first"))
    known = whole.join(best, CLUSTER, "left")
    joined = staged(rows.join(known, CLUSTER), "clustered-reads")
    run = config.rescue_run
    one = F.col("n") == 1
    # A single read shows the tail in its raw clip, others in the cleaned one.
    shown = F.when(one, F.col("raw")).otherwise(F.col("clip"))
    tail = F.when(left, F.endswith(shown["seq"], F.lit("A" * run))).otherwise(F.startswith(shown["seq"], F.lit("T" * run)))
    lone = joined.filter(tail & (one | (~F.col("barred") & (F.col("n_best") < config.min_evidence_reads))))
    kept = lone.groupBy(*CLUSTER).agg(F.min_by(F.struct("bp", "raw", "clip", "unclipped", "qname", "is_read1", "has_mate", "first", "n"), F.struct("bp", "ordinal")).alias("r"))
    source = F.when(F.col("r.n") == 1, F.when(left, S.q_revcomp(F.col("r.raw"))).otherwise(F.col("r.raw"))).otherwise(F.when(left, S.q_revcomp(F.col("r.clip"))).otherwise(F.col("r.clip")))
    kept = staged(kept.withColumn("clipped", S.clean_clip(source, config)).filter(F.length("clipped.seq") >= config.min_clip), "lone-reads")
    lone_out = kept.select(*CLUSTER, F.col("r.bp").alias("bp"), "clipped", F.col("r.unclipped").alias("aligned"), F.lit(1).cast("long").alias("n_reads"), F.col("r.first").alias("first"))
    lone_mates = kept.filter("r.has_mate").select(*CLUSTER, F.col("r.qname").alias("qname"), (~F.col("r.is_read1")).alias("want_read1"))

    many = joined.filter(~one & ~F.col("barred") & (F.col("n_best") >= config.min_evidence_reads))
    d = F.col("bp") - F.col("best")
    clip, unc = F.col("clip"), F.col("unclipped")
    vote = lambda c, a: F.struct(c.alias("c"), a.alias("a"))
    n_clip, n_unc = F.length("clip.seq"), F.length("unclipped.seq")
    back = S.q_revcomp
    to_right = (
        F.when(d == 0, vote(clip, back(unc)))
        .when((d > 0) & (d < n_clip), vote(S.q_concat(S.q_slice(unc, -d), clip), back(S.q_slice(unc, 0, -d))))
        .when((d < 0) & (-d < n_unc), vote(S.q_slice(clip, -d), S.q_concat(back(S.q_slice(clip, 0, -d)), back(unc))))
    )
    to_left = (
        F.when(d == 0, vote(clip, unc))
        .when((d > 0) & (d < n_unc), vote(S.q_slice(clip, d), S.q_concat(back(S.q_slice(clip, 0, d)), unc)))
        .when((d < 0) & (-d < n_clip), vote(S.q_concat(back(S.q_slice(unc, 0, -d)), clip), S.q_slice(unc, -d)))
    )
    unshifted = vote(clip, unc) if config.left_double_vote else F.lit(None)
    ballots = F.filter(F.when(left, F.array(to_left, unshifted)).otherwise(F.array(to_right)), lambda v: v.isNotNull())
    cast = staged(many.select(*CLUSTER, F.explode(ballots).alias("v")), "votes")
    of = lambda part, name: weighted_consensus(cast.select(*CLUSTER, F.col(f"v.{part}.seq").alias("seq"), F.col(f"v.{part}.qual").alias("qual")), CLUSTER, "seq", "qual").select(*CLUSTER, S.quality_seq(F.col("seq"), F.col("qual")).alias(name))
    counts = cast.groupBy(*CLUSTER).agg(F.count("*").alias("n_reads"))
    merged = of("c", "clipped").join(of("a", "aligned"), CLUSTER).join(counts, CLUSTER).join(known.select(*CLUSTER, F.col("best").alias("bp"), "first"), CLUSTER)
    merged = staged(merged.withColumn("repeat", S.is_short_repeat(F.col("clipped.seq"))), "consensus")
    passed = merged.filter((F.length("clipped.seq") > config.min_clip) & (F.length("aligned.seq") > config.min_aligned) & ~F.col("repeat"))
    out = passed.select(*CLUSTER, "bp", "clipped", "aligned", "n_reads", "first").unionByName(lone_out)
    mates = many.filter("has_mate").select(*CLUSTER, "qname", (~F.col("is_read1")).alias("want_read1")).join(passed.select(*CLUSTER), CLUSTER, "left_semi").unionByName(lone_mates)
    sized = merged.select(*CLUSTER, F.length("clipped.seq").alias("clip_size"), F.length("aligned.seq").alias("aligned_size"), "repeat")
    known = known.join(kept.select(*CLUSTER, F.lit(True).alias("rescued")), CLUSTER, "left").join(sized, CLUSTER, "left")
    reason = reports.cluster_outcome(F.col("n"), F.col("barred"), F.col("n_best"), F.coalesce("rescued", F.lit(False)), F.col("clip_size"), F.col("aligned_size"), F.col("repeat"), config)
    return out, mates, known.select(*CLUSTER, "n", reason.alias("outcome"))


def polya_reads(reads: DataFrame, config: Config = MOUSE) -> DataFrame:
    """Badly mapped reads with a poly-A or poly-T run: sample, ordinal, qname, is_read1, flag, kind, side, clipped."""
    rows = reads.filter((F.col("mapq") < config.min_mapq) & F.col("seq").isNotNull() & F.col("qual").isNotNull()).withColumn("kind", S.polya_kind(F.col("seq"), F.col("flag"), config.polya_run)).filter("kind is not null")
    q = S.quality_seq(F.col("seq"), F.col("qual"))
    rows = rows.select("sample", "ordinal", "qname", S.has_flag(F.col("flag"), S.READ1).alias("is_read1"), "flag", "kind", S.polya_side(F.col("flag"), F.col("kind")).alias("side"), S.polya_clip(q, F.col("flag"), F.col("kind"), config).alias("clipped"))
    return rows.filter(F.length("clipped.seq") > 0)
